"""Pseudonyms of numbers beside other numbers and words."""

import datetime
import re

from gridloom.llm import pii
from test_rest import luhn, plain_feistel, plain_permuted


def replaced(spark, texts):
    return pii.pseudonymized(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()


def test_numbers_beside_others(spark):
    card, iban, compact = "4111 1111 1111 1111", "BE68 5390 0754 7034", "ES9121000418450200051332"
    texts = [f"é {card} 12/25", "4111111111111111 123 ", f"x {iban} IN b", f"{compact} WAS", f"{iban} {compact} {iban} TO {card} 12/25, {compact}", f"no 12 {card}.", f"{iban} {card}", f"{card} 12 999.1.1.1 a.b@c.org {iban} IN"]
    counts = [(1, 0), (1, 0), (0, 1), (0, 1), (1, 4), (1, 0), (1, 1), (1, 1)]
    values = [card, card.replace(" ", ""), iban, compact, "a.b@c.org"]
    names = dict(zip(values, [r.text for r in replaced(spark, values)], strict=True))
    for text, row, n in zip(texts, replaced(spark, texts), counts, strict=True):
        assert row.text == re.sub("|".join(names), lambda m: names[m[0]], text) and (row.n_card, row.n_iban) == n


def test_rows_of_digits_stay(spark):
    texts = ["0000 0000 0000 0000 12", "4111 1111 1111 1112 12"]
    assert [r.text for r in replaced(spark, texts)] == texts


def test_every_kind_is_the_plain_feistel(spark):
    ssn, secret, day = "123-45-6789", "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde", datetime.date(1900, 1, 1)

    def turned(n):
        a, b = plain_feistel([n // 288], [n % 288], [256], [288], "date", pii.KEY)
        return a * 288 + b

    def date(text, form, walk=False):
        n = turned((datetime.datetime.strptime(text, form).date() - day).days)
        while walk and (day + datetime.timedelta(n)).day <= 12:
            n = turned(n)
        return (day + datetime.timedelta(n)).strftime(form)

    area, group, serial = plain_feistel([122], [44, 6788], [898], [99, 9999], "ssn", pii.KEY)
    body = plain_permuted("370400440532013000"[:18], pii.ALPHABETS[:3], "iban")
    check = 98 - int("".join(str(int(c, 36)) for c in body + "DE00")) % 97
    card = plain_permuted("4111.1111.1111.111", [pii.DIGITS], "card")
    want = {
        ssn: f"{area + (2 if area >= 665 else 1):03d}-{group + 1:02d}-{serial + 1:04d}",
        secret: plain_permuted(secret, pii.HEX[:1], "secret"),
        "2021-02-28": date("2021-02-28", "%Y-%m-%d"),
        "31.12.1999": date("31.12.1999", "%d.%m.%Y"),
        "12/31/1999": date("12/31/1999", "%m/%d/%Y"),
        "31/12/1980": date("31/12/1980", "%d/%m/%Y", walk=True),
        "DE89370400440532013000": f"DE{check:02d}{body}",
        "+44 20 7946 0958": "+44 " + plain_permuted("20 7946 0958", [pii.DIGITS], "phone"),
        "555 123 4567": plain_permuted("555 123 4567", [pii.DIGITS], "phone"),
        "4111.1111.1111.1111": card + next(d for d in pii.DIGITS if luhn(card + d)),
        "10.0.0.7": ".".join(map(str, plain_feistel([10, 0], [0, 7], [256] * 2, [256] * 2, "ip", pii.KEY))),
        "a.b12@c.org": plain_permuted("a.b12@c", pii.ALPHABETS, "email") + ".org",
    }
    rows = replaced(spark, [f"see {x}, or" for x in want])
    assert [r.text for r in rows] == [f"see {x}, or" for x in want.values()]
    assert all(sum(v for k, v in r.asDict().items() if k.startswith("n_")) == 1 for r in rows)


def test_day_first_dates_stay_apart(spark):
    days = [f"{d:02d}/{m:02d}/1999" for d in range(13, 29) for m in range(1, 13)]
    out = [r.text for r in replaced(spark, days)]
    assert len(set(out)) == len(days) and all(int(x[:2]) > 12 >= int(x[3:5]) for x in out)


def test_what_is_no_value_stays(spark):
    texts = ["3.14159265358979 and 12 555 123 4567 8", "1 234 5678", "0" * 40, "d" * 40, "1" * 32, "a..b@c.org", f"{'x' * 65}@c.org", "+1 23", "+000 000 0000", "32/13/1980 00/00/2000", "155 123 4567"]
    assert [r.text for r in replaced(spark, texts)][2:] == texts[2:]


def test_names_clash_without_regard_to_case(spark):
    df = spark.createDataFrame([(1, "a@b.org", "mine", "too")], "doc_id long, text string, _FOUND string, _Parts string")
    row = pii.pseudonymized(df, counts=False).first()
    assert tuple(row.__fields__) == ("doc_id", "text", "_FOUND", "_Parts") and (row[2], row[3]) == ("mine", "too") and row.text != "a@b.org"
