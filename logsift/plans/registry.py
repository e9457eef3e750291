"""The registered queries: each takes ``(spark, sf_dir)`` and returns a lazy
DataFrame over the supplied tables (or data Spark derives from them).

Inputs: the log store is rendered from ``events`` (``sources.fixtures``);
results are the store's own match rows. Every query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lines, lookup, matching, payload, stats, store, views
from ..sources import fixtures, patterns as P, tables
from . import micro_batch


def _events(spark, sf):
    return tables.table(spark, sf, "events")


def _logs(spark, sf):
    return fixtures.render_logs(_events(spark, sf))


def _matches(spark, sf):
    return matching.match_lines(_logs(spark, sf))


def _results(spark, sf):
    return store.results_rows(_matches(spark, sf))


def _marked(spark, sf):
    """Some logs are processed already."""
    return store.mark_processed(fixtures.existing_store(_events(spark, sf)), _results(spark, sf))


def _lookup(spark, sf):
    ev = _events(spark, sf)
    return lookup.bulk_lookup(fixtures.lookup_requests(ev), fixtures.render_logs(ev))


# The catalogue table of ``match_join``: the defaults plus two entries that
# repeat an id (one identical, one equivalent).
TABLE_CATALOGUE = P.DEFAULT_PATTERNS + [("LOG_TYPE_ERROR", r"\[ERROR\]"), ("DATA_SAVED", r"Data sav(ed)")]


# --- the core: contents -> lines -> matches ------------------------------


def q_normalize_content(spark, sf):
    return lines.normalize_content(_logs(spark, sf))


def q_split_lines(spark, sf):
    return lines.split_lines(_logs(spark, sf))


def q_clean_lines(spark, sf):
    return lines.clean_lines(_logs(spark, sf))


def q_match_array(spark, sf):
    with_arr = matching.match_array(lines.clean_lines(_logs(spark, sf)))
    return matching.match_summary(with_arr)


def q_match_lines(spark, sf):
    return _matches(spark, sf)


def q_match_distinct(spark, sf):
    """A store that repeats logs: each match row once."""
    return matching.match_lines(fixtures.repeated_logs(_events(spark, sf)), distinct_rows=True)


def q_match_join(spark, sf):
    """The catalogue held as a table (with repeated ids, which must not
    repeat match rows), size-checked and compiled into the plan."""
    table = P.to_frame(spark, P.catalogue(TABLE_CATALOGUE))
    return matching.match_lines(_logs(spark, sf), P.from_frame(table))


def q_match_custom(spark, sf):
    docs = fixtures.documents_as_logs(tables.table(spark, sf, "documents"))
    return matching.match_lines(docs, P.catalogue(fixtures.DOCUMENT_PATTERNS), id_col="doc_id")


def q_kafka_payload(spark, sf):
    return payload.kafka_payload(_matches(spark, sf))


# --- input side ------------------------------------------------------------


def q_decode_events(spark, sf):
    return lookup.decode_events(fixtures.event_values(_events(spark, sf)))


def q_bulk_lookup(spark, sf):
    return _lookup(spark, sf)


def q_valid_contents(spark, sf):
    return lines.valid_contents(_lookup(spark, sf)).select("log_id", "content")


def q_not_found_ids(spark, sf):
    return lookup.not_found_ids(_lookup(spark, sf))


def q_log_by_id(spark, sf):
    ev = _events(spark, sf)
    return lookup.log_by_id(fixtures.render_logs(ev), fixtures.lookup_requests(ev))


def q_batch_metrics(spark, sf):
    ev = _events(spark, sf)
    return payload.batch_metrics_single_pass(fixtures.lookup_requests(ev), fixtures.render_logs(ev))


# --- output side -------------------------------------------------------------


def q_results_rows(spark, sf):
    return _results(spark, sf)


def q_batch_match(spark, sf):
    return micro_batch.batch_match(_logs(spark, sf))


def q_mark_processed(spark, sf):
    return _marked(spark, sf)


def _raw_results(spark, sf):
    return fixtures.results_with_violations(_results(spark, sf), _events(spark, sf))


def q_results_accepted(spark, sf):
    return store.results_accepted(_raw_results(spark, sf), _logs(spark, sf))


def q_results_rejected(spark, sf):
    return store.results_rejected(_raw_results(spark, sf), _logs(spark, sf))


def q_cascade_delete(spark, sf):
    _, kept = store.cascade_delete(_logs(spark, sf), _results(spark, sf), fixtures.deleted_log_ids(_events(spark, sf)))
    return kept


def q_upsert_logs(spark, sf):
    ev = _events(spark, sf)
    return store.upsert_logs(fixtures.existing_store(ev), fixtures.log_writes(ev))


# --- read side -------------------------------------------------------------


def q_pending_logs(spark, sf):
    return views.pending_logs(_marked(spark, sf))


def q_results_for_log(spark, sf):
    return views.results_for_logs(_results(spark, sf), fixtures.lookup_requests(_events(spark, sf)))


def q_get_log_matches(spark, sf):
    """The SQL table function, called for every requested log."""
    ev = _events(spark, sf)
    views.register_sql(spark, fixtures.render_logs(ev), _results(spark, sf), prefix="ls_")
    fixtures.lookup_requests(ev).createOrReplaceTempView("ls_requests")
    return spark.sql(
        "SELECT q.log_id, m.regex_id, m.line_number, m.match, m.line_content "
        "FROM (SELECT DISTINCT log_id FROM ls_requests) q, LATERAL ls_get_log_matches(q.log_id) m"
    )


def q_error_logs(spark, sf):
    return views.error_logs(_logs(spark, sf), _results(spark, sf))


def q_stats(spark, sf):
    return stats.stats(_marked(spark, sf), _results(spark, sf))


def q_stats_record(spark, sf):
    return stats.stats_json(_marked(spark, sf), _results(spark, sf))


def q_matches_by_type(spark, sf):
    return stats.matches_by_type(_results(spark, sf))


# Buckets of the stream's log store (small: the supplied tables are small).
STREAM_BUCKETS = 16


# --- streaming -----------------------------------------------------------------


def q_stream_match(spark, sf):
    """The streaming job over the event table as a file stream (Kafka is not
    available here; the decode step takes any frame with a ``value``
    column). Runs every available batch, then reads the sink back."""
    from ..streaming import job

    from ..session import scratch_path
    from ..sources import stores

    # The log store as a bucketed table in the shared folder; each batch's
    # lookup reads only the buckets its ids fall in.
    logs = stores.write_bucketed(_logs(spark, sf), scratch_path(spark, "stores", "logs"), STREAM_BUCKETS)
    ev_schema = _events(spark, sf).schema
    stream = job.file_events(spark, f"{sf.rstrip('/')}/events*.parquet", ev_schema, max_files_per_trigger=1)
    envelope = fixtures.event_values(stream)
    out, _, _ = job.run_to_completion(spark, envelope, lambda: logs, bucket_count=STREAM_BUCKETS)
    if out is None:
        return spark.createDataFrame([], "regexId string, log_id string, line_number int, matched_text string")
    return out.select("regexId", "log_id", "line_number", "matched_text")


# Batches that the events are dealt into (event_id modulo this number).
STREAM_BATCHES = 3
# Events whose log is not in the store of the stream (event_id modulo this is 0).
STREAM_UNKNOWN = 19


def _streamed(spark, sf):
    """The stores after a stream of several batches with a restart between them, a
    second run of the last batch, as after a failure, and a fold of the others."""
    from ..operators.lookup import check_events
    from ..session import scratch_path
    from ..streaming import job
    from .versioned import VersionedStores

    ev = _events(spark, sf)
    base = scratch_path(spark, "stream_store")
    logs = fixtures.existing_store(ev.filter(F.col("event_id") % STREAM_UNKNOWN != 0))
    stores = VersionedStores.create(spark, f"{base}/stores", logs, bucket_count=STREAM_BUCKETS)
    values = fixtures.event_values(ev)
    parts = [values.filter(F.col("event_id") % STREAM_BATCHES == k) for k in range(STREAM_BATCHES)]
    writer = job.store_events(spark, stores, parts, base)
    writer(check_events(parts[-1]), STREAM_BATCHES - 1)
    stores.fold()
    return stores


def q_stream_store_results(spark, sf):
    return _streamed(spark, sf).read_results().select("log_id", "regex_id", "line_number", "match", "line_content")


def q_stream_store_stats(spark, sf):
    stores = _streamed(spark, sf)
    return stats.stats_json(stores.read_logs(), stores.read_results())


def q_stream_store_pending(spark, sf):
    return views.pending_logs(_streamed(spark, sf).read_logs())


def q_stream_store_errors(spark, sf):
    stores = _streamed(spark, sf)
    return views.error_logs(stores.read_logs(), stores.read_results())


def q_batch_metrics_history(spark, sf):
    return _streamed(spark, sf).metrics_history().drop("stream_id")


def q_rejected_events(spark, sf):
    return lookup.rejected_events(fixtures.event_values(_events(spark, sf)))


def q_batch_store_stats(spark, sf):
    """Batch mode over the stores: pending logs are matched, stored and flagged; a
    second run finds what is still pending, and nothing new in it."""
    from ..session import scratch_path
    from .versioned import VersionedStores

    logs = fixtures.existing_store(_events(spark, sf))
    stores = VersionedStores.create(spark, scratch_path(spark, "stores"), logs, bucket_count=STREAM_BUCKETS)
    stores.match_pending()
    stores.match_pending()
    return stats.stats_json(stores.read_logs(), stores.read_results())


def q_log_by_few_ids(spark, sf):
    """Point lookups in a bucketed store: the first and the last logs and an id that
    it lacks."""
    from ..session import scratch_path
    from ..sources import stores

    ev = _events(spark, sf)
    table = stores.write_bucketed(_logs(spark, sf), scratch_path(spark, "stores", "logs"), STREAM_BUCKETS)
    ends = ev.agg(F.min("event_id").alias("a"), F.max("event_id").alias("b")).select(F.explode(F.array("a", "b")).alias("e"))
    ids = ends.select(F.explode(F.array(fixtures.log_id_of(F.col("e")), F.lit("log_missing"))).alias("log_id"))
    return lookup.log_by_id(table, ids)


def q_versioned_delete(spark, sf):
    """Deleting logs hides them and their results at one commit: what is left in
    both stores, by log."""
    from ..session import scratch_path
    from .versioned import VersionedStores

    ev = _events(spark, sf)
    stores = VersionedStores.create(
        spark, scratch_path(spark, "stores"), fixtures.existing_store(ev), _results(spark, sf), STREAM_BUCKETS
    )
    stores.delete(fixtures.deleted_log_ids(ev))
    left = stores.read_results().groupBy("log_id").agg(F.count(F.lit(1)).alias("results"))
    return stores.read_logs().select("log_id").join(left, "log_id", "left").select("log_id", F.coalesce("results", F.lit(0)).alias("results"))


def q_stats_partials(spark, sf):
    """The statistics after an upsert, an append and a delete, from the partial
    counts of the buckets."""
    from ..session import scratch_path
    from . import maintenance

    ev = _events(spark, sf)
    none = _results(spark, sf).limit(0)
    stores = maintenance.LogStores.create(scratch_path(spark, "stores"), fixtures.existing_store(ev), none, STREAM_BUCKETS)
    stores = maintenance.post_logs(spark, stores, fixtures.log_writes(ev))
    stores, _ = maintenance.post_results(spark, stores, _results(spark, sf))
    stores = maintenance.delete_logs(spark, stores, fixtures.deleted_log_ids(ev))
    return maintenance.stored_stats(spark, stores)


def q_extract_fields(spark, sf):
    return matching.extract_fields(_logs(spark, sf))


# Patterns of the large catalogue that is derived from the documents.
LARGE_CATALOGUE = 5000


def large_catalogue(documents: DataFrame, size: int = LARGE_CATALOGUE) -> list[P.Pattern]:
    """``size`` patterns from the documents' own words: the distinct words of 5 to 12
    lower-case letters with the least hashes. Every 100th is a regex."""
    words = documents.select(F.explode(F.split("text", "[^a-z]+")).alias("w")).where("length(w) between 5 and 12").distinct()
    rows = words.orderBy(F.md5("w"), "w").limit(size).collect()
    return [P.Pattern(f"P{k:05d}", rf"{r.w}\w*\." if k % 100 == 0 else r.w) for k, r in enumerate(rows)]


def q_match_large(spark, sf):
    """A catalogue of thousands of patterns through the index of their texts."""
    from ..operators import catalogue_index

    docs = fixtures.documents_as_logs(tables.table(spark, sf, "documents"))
    patterns = large_catalogue(tables.table(spark, sf, "documents"))
    return catalogue_index.match_lines_indexed(docs, patterns, id_col="doc_id").select("regexId", "doc_id", "line_number")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
