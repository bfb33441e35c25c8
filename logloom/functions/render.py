"""Writing typed columns back as text lines."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions import fixed


def metric_line(
    time: Column, server: Column, level: Column, response: Column, cpu: Column, memory: Column, requests: Column
) -> Column:
    """One server-metric line; parsing it gives the same values back."""
    return F.concat_ws(
        fixed.FIELD_SEPARATOR,
        time,
        server,
        level,
        F.format_string("Response Time = %sms", response.cast("string")),
        F.format_string("CPU=%s%%", cpu.cast("string")),
        F.format_string("Memory=%sGB", memory.cast("string")),
        F.format_string("Requests=%s", requests.cast("string")),
    )


def severity(cpu: Column, response: Column) -> Column:
    """Severity of a server-metric row from its load."""
    overloaded = (cpu > fixed.ERROR_CPU_ABOVE) & (response > fixed.ERROR_RESPONSE_ABOVE)
    busy = cpu > fixed.WARNING_CPU_ABOVE
    return F.when(overloaded, "ERROR").when(busy, "WARNING").otherwise("INFO")
