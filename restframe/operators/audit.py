"""One audit row per call: the request, its response, its log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restframe.functions.loglines import exception_line, request_line, response_line
from restframe.spec import LookupSpec, SinkSpec


def audit_log(
    requests: DataFrame, responses: DataFrame, level: str | None = None, spec: LookupSpec | SinkSpec | None = None
) -> DataFrame:
    """Join requests with their responses (unique by request_id) and format both sides.

    ``level`` says how much is written, by default the ``logging.level`` option of ``spec``.
    """
    level = level if level is not None or spec is None else spec.logging_level
    called = requests.select(
        "request_id", "method", "url", F.col("body").alias("request_body"), F.col("headers").alias("sent_headers")
    ).join(responses, "request_id", "left")
    sent = F.transform_values("sent_headers", lambda _, v: F.array(v))
    asked = request_line(F.col("method"), F.col("url"), sent, level)
    answered = response_line(
        F.col("method"), F.col("url"), F.col("headers"), F.col("status"), F.col("body"), level
    )
    failed = exception_line(F.col("method"), F.col("url"), F.col("io_error"))
    return called.withColumn("request_line", asked).withColumn(
        "response_line", F.when(F.col("io_error").isNotNull(), failed).otherwise(answered)
    )
