"""Command line: ``python -m gridloom`` with ``query NAME TABLES OUT``, ``clean IMAGES OUT`` or ``ocr IMAGES OUT --backend MODULE:FACTORY``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def run_query(spark: SparkSession, name: str, tables: str, out: str) -> None:
    """Write the rows of a registered query as Parquet."""
    from gridloom.plans.registry import QUERIES

    QUERIES[name](spark, tables).write.mode("overwrite").parquet(out)


def clean_images(spark: SparkSession, images: str, out: str, glob: str, keep_on_error: bool) -> tuple[int, int]:
    """Clean the images below a folder and write them by name; files written and files read."""
    from gridloom.operators.runs import run_summary
    from gridloom.plans.extraction import cleaned_blocks
    from gridloom.sources import documents, files
    from gridloom.sources.staging import staged
    from pyspark.sql import functions as F

    cards = documents.images(spark, images, glob).drop("path")
    done = staged(files.write_named(files.image_content(cleaned_blocks(cards, keep_on_error)), out), "written")
    row = run_summary(done.select(F.col("success").alias("ok"), F.lit(0.0).alias("seconds"))).first()
    return row.successful, documents.image_files(spark, images, glob).count()


def read_images(spark: SparkSession, images: str, out: str, glob: str, backend: str, batch: int = 5) -> tuple[int, int]:
    """Recognise the images below a folder, a text file each; texts written and images found. The backend's factory is named module:name."""
    from importlib import import_module

    from gridloom.functions.text import stem
    from gridloom.operators import ocr
    from gridloom.sources import documents, files
    from gridloom.sources.staging import staged
    from pyspark.sql import functions as F

    module, _, name = backend.partition(":")
    found = ocr.recognized(documents.images(spark, images, glob).drop("path"), getattr(import_module(module), name), ["pdf_name", "file_name"], max(1, batch))
    texts = ocr.text_of(found).where("success").select("pdf_name", stem(F.col("file_name")).alias("stem"), "text")
    done = staged(files.write_named(files.text_files(texts), out), "written")
    return done.where("success").count(), documents.image_files(spark, images, glob).count()


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gridloom")
    commands = parser.add_subparsers(dest="command", required=True)
    query = commands.add_parser("query", help="write the rows of a registered query")
    for name in ("name", "tables", "out"):
        query.add_argument(name)
    clean = commands.add_parser("clean", help="remove borders and inner boxes from images")
    clean.add_argument("images")
    clean.add_argument("out")
    clean.add_argument("--glob", default="*.jpg")
    clean.add_argument("--keep-on-error", action="store_true")
    read = commands.add_parser("ocr", help="recognise the text on images")
    read.add_argument("images")
    read.add_argument("out")
    read.add_argument("--backend", required=True, help="module:factory")
    read.add_argument("--glob", default="*.jpg")
    read.add_argument("--batch", type=int, default=5)
    options = parser.parse_args(args)
    spark = SparkSession.builder.appName("gridloom").getOrCreate()
    if options.command == "query":
        run_query(spark, options.name, options.tables, options.out)
    elif options.command == "ocr":
        written, found = read_images(spark, options.images, options.out, options.glob, options.backend, options.batch)
        print(f"{written} of {found} texts written")
    else:
        written, found = clean_images(spark, options.images, options.out, options.glob, options.keep_on_error)
        print(f"{written} of {found} images written")


if __name__ == "__main__":
    main()
