"""What the first graphics device has free, as far as it tells."""

from __future__ import annotations


def device_stats() -> dict | None:
    """Name, memory in GiB, utilization and, where known, temperature of device 0; None without one."""
    try:
        import pynvml

        pynvml.nvmlInit()
        try:
            device = pynvml.nvmlDeviceGetHandleByIndex(0)
            memory = pynvml.nvmlDeviceGetMemoryInfo(device)
            name = pynvml.nvmlDeviceGetName(device)
            out = {"name": name.decode() if isinstance(name, bytes) else name}
            out |= {f"{k}_memory_gb": v / 1024**3 for k, v in (("total", memory.total), ("used", memory.used), ("free", memory.free))}
            out["utilization_percent"] = pynvml.nvmlDeviceGetUtilizationRates(device).gpu
            try:
                out["temperature_c"] = pynvml.nvmlDeviceGetTemperature(device, pynvml.NVML_TEMPERATURE_GPU)
            except pynvml.NVMLError:
                pass
            return out
        finally:
            pynvml.nvmlShutdown()
    except Exception:  # no driver, no device or no library
        return None
