"""Event sources, streaming steps and the sinks they feed, over the whole event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerwell.fixtures import base_table, fixture
from layerwell.functions.geo import ip_region, most_specific
from layerwell.operators.sequence import session_sequence
from layerwell.session import scratch_path
from layerwell.sinks.external import hot_users, sample_rows
from layerwell.sources.events import decode_events, table_stream
from layerwell.streaming.layers import (
    clean_events,
    enrich_events,
    flat_metrics,
    gold_table_sink,
    ingest_bronze,
    recent,
    user_metrics,
    write_gold,
    write_sequenced_silver,
    write_silver,
)
from layerwell.streaming.ledger import BatchLedger, files, gold_targets, write_targets
from layerwell.streaming.sessions import write_numbered
from layerwell.streaming.writers import AVAILABLE_NOW, append_evolving, fan_out, read_evolving, start_append
from registry.common import AS_OF_TIME, CTES, D, oracle, plain

PROPS = "map<string,string>"


def _source(spark, sf):
    """The event table as a stream of files."""
    schema = base_table(spark, sf, "events").schema
    # A glob path serves a single file as well as a directory of files.
    return table_stream(spark, f"{sf}/event[s].parquet", schema)


def _events(df):
    """Event rows in the fixture's shape, from a batch or streaming read of the event table."""
    text = lambda c: F.col(c).cast("string")
    return df.select(
        text("event_id").alias("event_id"),
        text("user_id").alias("user_id"),
        F.concat(F.lit("s"), text("user_id"), F.lit("-"), F.col("ts").cast("date").cast("string")).alias("session_id"),
        "event_type",
        F.col("ts").cast("timestamp").alias("event_time"),
        (F.col("event_id") % 200).cast("string").alias("product_id"),
        F.col("value").alias("amount"),
        ((F.col("event_id") * 7919) % 4294967296).alias("ip_num"),
        F.lit("agent").alias("user_agent"),
        F.col("props").alias("properties"),
    )


def _broker_records(events):
    """The rows as a broker delivers them: JSON bytes and an arrival time."""
    octets = [F.shiftright("ip_num", shift).bitwiseAND(255).cast("string") for shift in (24, 16, 8, 0)]
    event = F.struct(
        "event_id", "user_id", "session_id", "event_type", "event_time", "product_id", "amount",
        F.concat_ws(".", *octets).alias("ip_address"), "user_agent",
        F.from_json("properties", PROPS).alias("properties"),
    )
    as_json = F.to_json(event, {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    return events.select(as_json.cast("binary").alias("value"), F.col("event_time").alias("timestamp"))


def _decoded(df):
    return plain(df.withColumn("properties", F.element_at("properties", "k")))


def _run(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _statics(spark, sf):
    return [fixture(spark, sf, n) for n in ("user_profiles", "product_catalog", "ip_ranges")]


def _records(spark, sf, source=None):
    """Decoded broker records of the event table, from a batch or streaming read."""
    return decode_events(_broker_records(_events(base_table(spark, sf, "events") if source is None else source)))


def _enriched(spark, sf, source=None):
    return enrich_events(_records(spark, sf, source), *_statics(spark, sf), D)


def _metrics_input(spark, sf):
    return _enriched(spark, sf).select("user_id", "user_region", "event_type", "event_time", "amount")


def _metric_rows(df):
    return plain(df).withColumn("total_revenue", F.round("total_revenue", 4))


def _table_stream(spark, sf):
    path = scratch_path(spark, "append")
    stream = _events(_source(spark, sf))
    _run(start_append(stream, path, scratch_path(spark, "ckpt"), AVAILABLE_NOW, ["event_type"]))
    return plain(spark.read.parquet(path))


def _bronze(spark, sf):
    """Every record arrives twice; bronze keeps one."""
    path = scratch_path(spark, "bronze")
    events = _events(_source(spark, sf))
    raw = _broker_records(events.union(events))
    _run(ingest_bronze(raw, path, scratch_path(spark, "ckpt"), AVAILABLE_NOW))
    return _decoded(spark.read.parquet(path).drop("event_date"))


def _silver(spark, sf):
    path = scratch_path(spark, "silver")
    stream = _enriched(spark, sf, _source(spark, sf))
    _run(write_silver(stream, path, scratch_path(spark, "ckpt"), AVAILABLE_NOW))
    return _decoded(spark.read.parquet(path).withColumn("date", F.col("date").cast("string")))


def _sequenced(spark, sf):
    path = scratch_path(spark, "sequenced")
    stream = _records(spark, sf, _source(spark, sf))
    _run(
        write_sequenced_silver(
            stream, lambda: _enriched(spark, sf), path, scratch_path(spark, "ckpt"), AVAILABLE_NOW
        )
    )
    return plain(spark.read.parquet(path).select("event_id", "user_id", "session_id", "event_time", "seq", "prev_time"))


def _read_gold(spark, path):
    return _metric_rows(spark.read.parquet(path).withColumn("window_date", F.col("window_date").cast("string")))


def _gold(spark, sf):
    path = scratch_path(spark, "gold")
    stream = _enriched(spark, sf, _source(spark, sf))
    _run(write_gold(user_metrics(stream), [gold_table_sink(path)], scratch_path(spark, "ckpt"), AVAILABLE_NOW))
    return _read_gold(spark, path)


def _gold_restarted(spark, sf):
    """Purchases first, then all events from a fresh checkpoint, whose batch numbers start again."""
    path = scratch_path(spark, "gold")
    for events in ("event_type = 'purchase'", "true"):
        stream = _enriched(spark, sf, _source(spark, sf)).where(events)
        _run(write_gold(user_metrics(stream), [gold_table_sink(path)], scratch_path(spark, "ckpt"), AVAILABLE_NOW))
    return _read_gold(spark, path)


def _bronze_to_gold(spark, sf):
    """JSON bytes to bronze, bronze to silver, silver to gold, each a stream over the files of the one before."""
    bronze, silver, gold = (scratch_path(spark, layer) for layer in ("bronze", "silver", "gold"))
    again = lambda path: table_stream(spark, path, spark.read.parquet(path).schema)
    ckpt = lambda: scratch_path(spark, "ckpt")
    _run(ingest_bronze(_broker_records(_events(_source(spark, sf))), bronze, ckpt(), AVAILABLE_NOW))
    _run(write_silver(enrich_events(again(bronze), *_statics(spark, sf), D), silver, ckpt(), AVAILABLE_NOW))
    _run(write_gold(user_metrics(again(silver)), [gold_table_sink(gold)], ckpt(), AVAILABLE_NOW))
    return _read_gold(spark, gold)


def _fan_out(spark, sf):
    """Each micro-batch to two sinks: all events, and purchases only."""
    everything, purchases = scratch_path(spark, "all"), scratch_path(spark, "purchases")
    sinks = [
        lambda batch, name: append_evolving(batch, everything, name),
        lambda batch, name: append_evolving(batch.where("event_type = 'purchase'"), purchases, name),
    ]
    _run(fan_out(_events(_source(spark, sf)), sinks, scratch_path(spark, "ckpt"), AVAILABLE_NOW))
    counted = [
        spark.read.parquet(path).agg(F.lit(sink).alias("sink"), F.count("*").alias("n_rows"))
        for sink, path in (("all", everything), ("purchases", purchases))
    ]
    return counted[0].unionByName(counted[1])


def _evolving(spark, sf):
    """Events without a region first, then the enriched ones with new columns."""
    path = scratch_path(spark, "evolving")
    rows = _enriched(spark, sf).select("event_id", "event_type", "user_region", "user_segment")
    append_evolving(rows.select("event_id", "event_type"), path)
    append_evolving(rows, path)
    return (
        read_evolving(spark, path)
        .groupBy("event_type", "user_region", "user_segment")
        .agg(F.count("*").alias("n_rows"))
    )


END = "9999"


def _numbered(spark, sf):
    """Events come up to four minutes late, in four files; a last event past all others lets the rest become final."""
    events = fixture(spark, sf, "ods_events").select("event_id", "user_id", "session_id", "event_type", "event_time", "amount")
    arrives = F.col("event_time") + F.make_dt_interval(mins=F.col("event_id").cast("long") % 5)
    first, last = events.agg(F.min(arrives), F.max(arrives)).first()
    path, out = scratch_path(spark, "arriving"), scratch_path(spark, "numbered")
    part = F.floor((F.unix_micros(arrives) - F.lit(first.timestamp()) * 1_000_000) * 4 / F.lit((last - first).total_seconds() * 1_000_001))
    for number in range(4):
        events.where(part == number).write.mode("append").parquet(path)
    closing = events.limit(1).withColumns({"event_id": F.lit(END), "session_id": F.lit(END), "event_time": F.col("event_time") + F.expr("INTERVAL 400 DAYS")})
    closing.write.mode("append").parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    _run(write_numbered(stream, out, scratch_path(spark, "ckpt"), AVAILABLE_NOW))
    return plain(spark.read.parquet(out).where(F.col("session_id") != END))


TARGET_REVENUE = 100


def _gold_targets(spark, sf):
    """Rows and revenue that each of the four targets holds, and what the ledger says they were given."""
    paths = {name: scratch_path(spark, name) for name in ("table", "metrics", "index", "hot_users", "ledger")}
    ledger = BatchLedger(spark, paths["ledger"])
    targets = gold_targets(paths["table"], *(files(paths[n]) for n in ("metrics", "index", "hot_users")), TARGET_REVENUE)
    stream = _enriched(spark, sf, _source(spark, sf))
    _run(write_targets(user_metrics(stream), targets, ledger, scratch_path(spark, "ckpt"), AVAILABLE_NOW))
    held = [
        spark.read.parquet(paths[name]).agg(F.count("*").alias("n_rows"), F.round(F.sum("total_revenue"), 2).alias("revenue")).withColumn("target", F.lit(name))
        for name in targets
    ]
    rows = held[0].unionByName(held[1]).unionByName(held[2]).unionByName(held[3])
    given = ledger.entries().groupBy(F.col("sink").alias("target")).agg(F.sum("rows").alias("rows_given"))
    return rows.join(given, "target")


NESTED = """
SELECT ip_from, ip_to, region FROM {ranges}
UNION ALL SELECT ip_from + 100000000, ip_from + 200000000, concat('inner ', region) FROM {ranges}
UNION ALL SELECT ip_from + 120000001, ip_from + 130000007, concat('core ', region) FROM {ranges}
UNION ALL SELECT ip_from + 750000000, ip_from + 850000000, concat('border ', region) FROM {ranges}
"""


def _nested(spark, sf):
    """Region of every event's address, where ranges lie in and across each other."""
    ranges = spark.sql(NESTED, ranges=fixture(spark, sf, "ip_ranges"))
    events = fixture(spark, sf, "ods_events").select("event_id", "ip_num")
    return ip_region(events, most_specific(ranges))


def _hot_users(spark, sf):
    """Users whose purchases over all windows and regions exceed the threshold."""
    per_user = user_metrics(_metrics_input(spark, sf)).groupBy("user_id").agg(F.sum("total_revenue").alias("total_revenue"))
    return hot_users(per_user).withColumn("total_revenue", F.round("total_revenue", 4))


QUERIES = {
    "decode_events": lambda s, d: _decoded(decode_events(_broker_records(fixture(s, d, "ods_events")))),
    "table_stream": _table_stream,
    "ingest_bronze": _bronze,
    "clean_events": lambda s, d: plain(clean_events(fixture(s, d, "ods_events").union(fixture(s, d, "ods_events")))),
    "enrich_events": lambda s, d: _decoded(_enriched(s, d)),
    "session_sequence": lambda s, d: plain(
        session_sequence(fixture(s, d, "ods_events").select("event_id", "user_id", "session_id", "event_time"))
    ),
    "write_sequenced_silver": _sequenced,
    "user_metrics": lambda s, d: _metric_rows(flat_metrics(user_metrics(_metrics_input(s, d)))),
    "recent": lambda s, d: plain(recent(fixture(s, d, "ods_events"), AS_OF_TIME)),
    "write_silver": _silver,
    "write_gold": _gold,
    "write_gold_restarted": _gold_restarted,
    "bronze_to_gold": _bronze_to_gold,
    "fan_out": _fan_out,
    "stream_sequence": _numbered,
    "ip_region_nested": _nested,
    "gold_targets": _gold_targets,
    "append_evolving": _evolving,
    "sample_rows": lambda s, d: plain(sample_rows(fixture(s, d, "ods_events"), ["event_id"])),
    "hot_users": _hot_users,
}

CTES["addressed_events"] = """
SELECT * EXCLUDE (properties),
  concat_ws('.', CAST(ip_num // 16777216 AS VARCHAR), CAST(ip_num // 65536 % 256 AS VARCHAR),
    CAST(ip_num // 256 % 256 AS VARCHAR), CAST(ip_num % 256 AS VARCHAR)) AS ip_address,
  json_extract_string(properties, '$.k') AS properties, event_time AS kafka_timestamp
FROM ods_events
"""

CTES["enriched_events"] = f"""
SELECT e.* EXCLUDE (ip_num), u.user_segment, regexp_replace(u.phone, '[^0-9]', '', 'g') AS clean_phone,
  CAST(year(DATE '{D}') - year(TRY_CAST(u.birth_date AS DATE)) - CASE WHEN strftime(DATE '{D}', '%m%d')
    < strftime(TRY_CAST(u.birth_date AS DATE), '%m%d') THEN 1 ELSE 0 END AS INT) AS user_age,
  p.category AS product_category, r.region AS user_region, CAST(CAST(e.event_time AS DATE) AS VARCHAR) AS date
FROM addressed_events e LEFT JOIN user_profiles u ON e.user_id = u.user_id LEFT JOIN product_catalog p ON e.product_id = p.product_id
LEFT JOIN ip_ranges r ON e.ip_num BETWEEN r.ip_from AND r.ip_to
"""


def _metrics_sql(interval: str, keep: str = "TRUE") -> str:
    return (
        "SELECT user_id, user_region, CAST(w AS VARCHAR) AS window_start, "
        f"CAST(w + INTERVAL {interval} AS VARCHAR) AS window_end, COUNT(*) AS event_count, "
        "ROUND(SUM(CASE WHEN event_type = 'purchase' THEN amount ELSE 0 END), 4) AS total_revenue, "
        "CAST(CAST(w AS DATE) AS VARCHAR) AS window_date FROM (SELECT *, "
        f"time_bucket(INTERVAL {interval}, event_time, TIMESTAMP '1970-01-01') AS w FROM enriched_events WHERE {keep}) t "
        "GROUP BY user_id, user_region, w"
    )


_TIME = "CAST(event_time AS VARCHAR) AS event_time"
_ARRIVED = "CAST(kafka_timestamp AS VARCHAR) AS kafka_timestamp"
_DECODED = oracle(f"SELECT * EXCLUDE (ip_num) REPLACE ({_TIME}, {_ARRIVED}) FROM addressed_events")
_SEQUENCE = oracle("""
SELECT event_id, user_id, session_id, CAST(event_time AS VARCHAR) AS event_time,
  CAST(ROW_NUMBER() OVER (PARTITION BY user_id, session_id ORDER BY event_time, event_id) AS BIGINT) AS seq,
  CAST(LAG(event_time) OVER (PARTITION BY user_id, session_id ORDER BY event_time, event_id) AS VARCHAR) AS prev_time
FROM ods_events""")
_ENRICHED = oracle(f"SELECT * REPLACE ({_TIME}, {_ARRIVED}) FROM enriched_events")
_SAMPLED = "CAST('0x' || substr(md5(event_id), 1, 8) AS BIGINT) % 10000 < 1000"

_WINDOWS = _metrics_sql("5 MINUTE")
_KEY = "concat_ws('|', window_start, user_id, coalesce(user_region, ''))"

ORACLES = {
    "ip_region_nested": oracle(f"""
WITH nested AS ({NESTED.format(ranges="ip_ranges")})
SELECT e.event_id, e.ip_num, r.region AS user_region FROM ods_events e LEFT JOIN nested r ON e.ip_num BETWEEN r.ip_from AND r.ip_to
QUALIFY ROW_NUMBER() OVER (PARTITION BY e.event_id ORDER BY r.ip_to - r.ip_from, r.ip_from, r.region) = 1"""),
    "stream_sequence": oracle("""
SELECT event_id, user_id, session_id, event_type, CAST(event_time AS VARCHAR) AS event_time, amount,
  CAST(ROW_NUMBER() OVER (PARTITION BY user_id, session_id ORDER BY event_time, event_id) AS BIGINT) AS seq,
  CAST(LAG(event_time) OVER (PARTITION BY user_id, session_id ORDER BY event_time, event_id) AS VARCHAR) AS prev_time
FROM ods_events"""),
    "gold_targets": oracle(f"""
WITH windows AS ({_WINDOWS}),
held AS (
  SELECT 'table' AS target, total_revenue FROM windows
  UNION ALL SELECT 'metrics', total_revenue FROM windows
  UNION ALL SELECT 'index', total_revenue FROM windows WHERE CAST('0x' || substr(md5({_KEY}), 1, 8) AS BIGINT) % 10000 < 1000
  UNION ALL SELECT 'hot_users', max(total_revenue) FROM windows WHERE total_revenue > {TARGET_REVENUE} GROUP BY user_id
)
SELECT target, count(*) AS n_rows, round(sum(total_revenue), 2) AS revenue, (SELECT count(*) FROM windows) AS rows_given
FROM held GROUP BY target"""),
    "decode_events": _DECODED,
    "table_stream": oracle(f"SELECT * REPLACE ({_TIME}) FROM ods_events"),
    "ingest_bronze": _DECODED,
    "clean_events": oracle(f"SELECT * REPLACE ({_TIME}) FROM ods_events WHERE amount IS NULL OR amount >= 0"),
    "enrich_events": _ENRICHED,
    "session_sequence": _SEQUENCE,
    "write_sequenced_silver": _SEQUENCE,
    "user_metrics": oracle(_metrics_sql("5 MINUTE")),
    "recent": oracle(
        f"SELECT * REPLACE ({_TIME}) FROM ods_events WHERE event_time >= TIMESTAMP '{AS_OF_TIME}' - INTERVAL 1 HOUR"
    ),
    "write_silver": _ENRICHED,
    "write_gold": oracle(_metrics_sql("5 MINUTE")),
    "write_gold_restarted": oracle(_metrics_sql("5 MINUTE")),
    "bronze_to_gold": oracle(_metrics_sql("5 MINUTE", "amount IS NULL OR amount >= 0")),
    "sample_rows": oracle(f"SELECT * REPLACE ({_TIME}) FROM ods_events WHERE {_SAMPLED}"),
    "fan_out": "SELECT 'all' AS sink, COUNT(*) AS n_rows FROM events UNION ALL "
    "SELECT 'purchases', COUNT(*) FROM events WHERE event_type = 'purchase'",
    "append_evolving": oracle(
        "SELECT event_type, user_region, user_segment, COUNT(*) AS n_rows FROM (SELECT event_type, user_region, user_segment "
        "FROM enriched_events UNION ALL SELECT event_type, NULL, NULL FROM enriched_events) t GROUP BY ALL"
    ),
    "hot_users": oracle(
        "SELECT user_id, ROUND(SUM(amount), 4) AS total_revenue FROM ods_events WHERE event_type = 'purchase' "
        "GROUP BY user_id HAVING SUM(amount) > 1000"
    ),
}
