"""Inputs derived from the supplied tables.

The supplied tables hold no log text, so the log store is rendered from
``events`` by a fixed, deterministic rule that follows the log producer's
grammar (a header line with level, user, session, IP and message, then
"Additional info" lines), with line-end, prefix and empty-line variations
that exercise every cleaning rule. Every derived input is a projection of
``events``, so its size grows with the table; nothing is generated on the
driver.

The same rules are written in SQL in ``logsift.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: log levels by event type and the producer's message sets,
# in source order.
LEVEL_BY_EVENT_TYPE = {"error": "ERROR", "purchase": "WARNING", "signup": "DEBUG"}
DEFAULT_LEVEL = "INFO"
ERROR_MESSAGES = [
    "NullPointerException",
    "OutOfMemoryError",
    "FileNotFoundException",
    "ConnectionRefused",
    "Timeout waiting for response",
]
WARNING_MESSAGES = [
    "Connection attempt timed out",
    "Retrying operation",
    "Slow query detected",
    "Low memory warning",
    "Warning: deprecated method used",
]
OTHER_MESSAGES = [
    "User logged in",
    "Page viewed",
    "Request processed successfully",
    "Data saved",
    "Operation completed",
]
LOG_SOURCE = "log-producer"

# FIXED VALUES: a user-defined catalogue for free text (documents).
DOCUMENT_PATTERNS = [
    ("IPV4_ADDRESS", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b"),
    ("EMAIL_ADDRESS", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("SECRET_TOKEN", r"token = \"[0-9a-f]+"),
    ("LICENSE_LINE", r"(?i)licen[cs]e"),
    ("PHONE_NUMBER", r"\+1 \(\d{3}\) \d{3}-\d{4}"),
    ("CARD_NUMBER", r"\b\d{16}\b"),
    ("AT_SIGN", r"@"),
]


def lpad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def log_id_of(e: Column) -> Column:
    return F.concat(F.lit("log_"), lpad(e, 10))


def _info_line(prefix: Column, request: Column, millis: Column) -> Column:
    return F.concat(
        prefix,
        F.lit("Additional info: request_id="),
        lpad(request, 10),
        F.lit(", process_time="),
        millis.cast("string"),
        F.lit("ms"),
    )


def render_logs(events: DataFrame, processed: Column | None = None) -> DataFrame:
    """The log store: ``log_id, source, timestamp, content, processed``.

    Rules, with ``e = event_id``: content is null when ``e % 17 = 0``; lines
    are joined by ``\\r\\n`` (``e % 7 = 0``), ``\\r`` (``= 1``) or ``\\n``; the
    header carries the level from ``event_type`` and message ``1 + e % 5`` of
    that level's set; ``e % 6`` decides how many follow-up lines there are.
    """
    e = F.col("event_id")
    level = F.coalesce(
        *[F.when(F.col("event_type") == k, F.lit(v)) for k, v in LEVEL_BY_EVENT_TYPE.items()],
        F.lit(DEFAULT_LEVEL),
    )
    idx = (e % 5 + 1).cast("int")
    message = (
        F.when(level == "ERROR", F.element_at(F.array(*map(F.lit, ERROR_MESSAGES)), idx))
        .when(level == "WARNING", F.element_at(F.array(*map(F.lit, WARNING_MESSAGES)), idx))
        .otherwise(F.element_at(F.array(*map(F.lit, OTHER_MESSAGES)), idx))
    )
    header = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.lit(" ["),
        level,
        F.lit("] user_id=user_"),
        F.col("user_id").cast("string"),
        F.lit(" session_id=session_"),
        lpad(e, 8),
        F.lit(" from IP 192.168.1."),
        (e % 254 + 1).cast("string"),
        F.lit(": "),
        message,
    )
    sep = F.when(e % 7 == 0, F.lit("\r\n")).when(e % 7 == 1, F.lit("\r")).otherwise(F.lit("\n"))
    prefix = F.when(e % 11 == 0, F.lit("\t")).when(e % 11 == 1, F.lit(" é ")).otherwise(F.lit("    "))
    part2 = F.when(e % 6 >= 1, _info_line(prefix, e, e % 491 + 10))
    part3 = F.when(e % 6 >= 3, F.lit(""))
    part4 = F.when(e % 6 >= 3, _info_line(F.lit("    "), e + 1, e % 97 + 10))
    part5 = F.when(e % 6 >= 5, F.lit("\t"))
    # concat_ws skips the null parts; its separator is a per-row expression.
    joined = F.call_function("concat_ws", sep, header, part2, part3, part4, part5)
    content = F.when(e % 17 == 0, F.lit(None).cast("string")).otherwise(joined)
    return events.select(
        log_id_of(e).alias("log_id"),
        F.lit(LOG_SOURCE).alias("source"),
        F.col("ts").alias("timestamp"),
        content.alias("content"),
        (F.lit(False) if processed is None else processed).alias("processed"),
    )


def event_values(events: DataFrame) -> DataFrame:
    """The event stream's message values as a Kafka-like envelope: ``value``
    (binary JSON of ``log_id, timestamp, source``), plus ``event_id`` and
    ``ts`` for ordering. Some values are broken on purpose: ``e % 23 = 0`` is
    not JSON, ``e % 29 = 0`` has no log_id, ``e % 31 = 0`` has log_id ``''``.
    """
    e = F.col("event_id")
    log_id = F.when(e % 29 == 0, F.lit(None).cast("string")).when(e % 31 == 0, F.lit("")).otherwise(log_id_of(e))
    body = F.to_json(
        F.struct(
            log_id.alias("log_id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            F.lit(LOG_SOURCE).alias("source"),
        )
    )
    value = F.when(e % 23 == 0, F.lit("not json")).otherwise(body)
    return events.select(e.alias("event_id"), F.col("ts"), value.cast("binary").alias("value"))


def lookup_requests(events: DataFrame) -> DataFrame:
    """Ids asked of the store: every log, a second request for ``e % 20 = 0``
    logs (duplicates), and unknown ids for ``e % 50 = 0``."""
    e = F.col("event_id")
    ids = F.array_compact(
        F.array(
            log_id_of(e),
            F.when(e % 20 == 0, log_id_of(e)),
            F.when(e % 50 == 0, F.concat(F.lit("log_missing_"), e.cast("string"))),
        )
    )
    return events.select(F.explode(ids).alias("log_id"))


def repeated_logs(events: DataFrame) -> DataFrame:
    """The log store with a second copy of the logs with ``e % 5 = 0``."""
    copies = F.explode(F.when(F.col("event_id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return render_logs(events.withColumn("copy", copies))


def existing_store(events: DataFrame) -> DataFrame:
    """Store before the upsert: every log, processed when ``e % 4 = 0``."""
    e = F.col("event_id")
    return render_logs(events, processed=(e % 4 == 0))


def log_writes(events: DataFrame) -> DataFrame:
    """Writes to upsert, with an arrival sequence ``seq``. Per event: an
    update of its log (content plus ``'\nupdated'``) and a new log
    ``log_new_<e>`` with the same text, both from source ``writer-1`` at seq
    ``e``; for ``e % 9 = 0`` a second write of both with null content from
    ``writer-2`` at seq ``e + 10^9``."""
    e = F.col("event_id")
    base = render_logs(events).select(
        "log_id", "timestamp", "content", F.substring("log_id", 5, 10).cast("long").alias("e")
    )
    new_id = F.concat(F.lit("log_new_"), F.substring("log_id", 5, 10))
    first = base.select(
        F.explode(
            F.array(
                F.struct(F.col("log_id"), F.concat("content", F.lit("\nupdated")).alias("content")),
                F.struct(new_id.alias("log_id"), F.col("content")),
            )
        ).alias("w"),
        "timestamp",
        "e",
    ).select(
        "w.log_id",
        F.lit("writer-1").alias("source"),
        "timestamp",
        "w.content",
        F.col("e").alias("seq"),
    )
    second = base.filter(F.col("e") % 9 == 0).select(
        F.explode(F.array(F.col("log_id"), new_id)).alias("log_id"),
        F.lit("writer-2").alias("source"),
        "timestamp",
        F.lit(None).cast("string").alias("content"),
        (F.col("e") + F.lit(1_000_000_000)).alias("seq"),
    )
    return first.unionByName(second)


def deleted_log_ids(events: DataFrame) -> DataFrame:
    """Logs removed from the store: ``e % 13 = 0``."""
    e = F.col("event_id")
    return events.filter(e % 13 == 0).select(log_id_of(e).alias("log_id"))


def results_with_violations(results: DataFrame, events: DataFrame) -> DataFrame:
    """Result rows plus rows that break each of the store's constraints: unknown
    log ids (``e % 50 = 0``), null log ids (``e % 43 = 0``), null regex ids
    (``e % 47 = 0``), null line numbers (``e % 53 = 0``), null matches
    (``e % 37 = 0``), 51-character regex ids (``e % 41 = 0``) and 256-character
    log ids (``e % 59 = 0``)."""
    e = F.col("event_id")

    def row(every: int, log_id=None, regex_id="LOG_TYPE_INFO", line_number=1, match="x") -> Column:
        fields = (
            (log_id_of(e) if log_id is None else log_id).cast("string").alias("log_id"),
            F.lit(regex_id).cast("string").alias("regex_id"),
            F.lit(line_number).cast("int").alias("line_number"),
            F.lit(match).cast("string").alias("match"),
            F.lit(None).cast("string").alias("line_content"),
        )
        return F.when(e % every == 0, F.struct(*fields))

    rows = F.array_compact(
        F.array(
            row(50, log_id=F.concat(F.lit("log_missing_"), e.cast("string"))),
            row(43, log_id=F.lit(None)),
            row(47, regex_id=None),
            row(53, line_number=None),
            row(37, match=None),
            row(41, regex_id="X" * 51),
            row(59, log_id=F.rpad(log_id_of(e), 256, "y")),
        )
    )
    bad = events.select(F.explode(rows).alias("r")).select("r.*")
    return results.select("log_id", "regex_id", "line_number", "match", "line_content").unionByName(bad)


def documents_as_logs(documents: DataFrame) -> DataFrame:
    """Free text as (doc_id, content)."""
    return documents.select("doc_id", F.col("text").alias("content"))
