"""Trace documents, live snapshots and JSON lines to positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schema import MAX_CORRUPT_SHARE, MAX_DETAIL_AGE_S, POSITIONS


def traces(documents: DataFrame, column: str = "document") -> DataFrame:
    """One row per point with a position: details are carried forward in array order and hold for a minute.

    A record replaces all its values, by null too; the callsign stays until a
    newer one comes.  A document that is no JSON gives no rows.
    """
    doc = documents.select(F.monotonically_increasing_id().alias("_doc"), F.try_parse_json(column).alias("v"))
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    doc = doc.select(
        "_doc", F.regexp_replace(F.lower(get("$.icao", "string")), "^~", "").alias("icao24"), get("$.timestamp", "double").alias("t0"),
        (F.coalesce(get("$.dbFlags", "int"), F.lit(0)).bitwiseAND(F.lit(12)) != 0).alias("anonymous"), F.posexplode(get("$.trace", "array<variant>")).alias("at", "p"),
    )
    el = lambda i, kind: F.try_variant_get("p", f"$[{i}]", kind)
    num = lambda i: F.when(F.schema_of_variant(el(i, "variant")).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT)"), el(i, "double"))
    detail = el(8, "variant")
    has = F.coalesce(F.schema_of_variant(detail).startswith("OBJECT"), F.lit(False))
    sub = lambda name, kind: F.try_variant_get("p", f"$[8].{name}", kind)
    p = doc.select("*", (F.col("t0") + num(0)).alias("t"), num(1).alias("lat"), num(2).alias("lon"), num(3).cast("float").alias("alt_baro_ft"), F.coalesce(el(3, "string") == "ground", F.lit(False)).alias("on_ground"), num(4).cast("float").alias("gs_kt"), num(5).cast("float").alias("track"), el(9, "string").alias("kind"), num(10).cast("float").alias("alt_geom_ft"), has.alias("has"))
    p = p.withColumns({"d": F.when(F.col("has"), F.struct(F.col("t").alias("t"), sub("nic", "int").alias("nic"), sub("nac_p", "int").alias("nac_p"), sub("sil", "int").alias("sil"))), "f": F.when(F.col("has"), F.nullif(F.trim(sub("flight", "string")), F.lit("")))})
    past = Window.partitionBy("_doc").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumns({"d": F.last("d", ignorenulls=True).over(past), "callsign": F.last("f", ignorenulls=True).over(past)})
    age = F.col("t") - F.col("d.t")
    held = lambda name: F.when(age <= MAX_DETAIL_AGE_S, F.col(f"d.{name}")).cast("tinyint").alias(name)
    return p.where("lat is not null and lon is not null and t is not null").select(
        F.timestamp_millis(F.floor(F.col("t") * 1000)).alias("ts"), "icao24", "lat", "lon", "alt_baro_ft", "alt_geom_ft", "gs_kt", "track", "callsign", held("nic"), held("nac_p"), held("sil"),
        F.when(age <= MAX_DETAIL_AGE_S, F.round(age, 2)).cast("float").alias("nic_age_s"), F.concat(F.lit("adsblol:"), F.coalesce(F.nullif("kind", F.lit("")), F.lit("unknown"))).alias("source"), "on_ground", "anonymous",
    )


def corrupt_share(documents: DataFrame, column: str = "document") -> DataFrame:
    """How many documents there are, how many are no JSON, and their share."""
    bad = F.count_if(F.try_parse_json(column).isNull())
    return documents.agg(F.count("*").alias("documents"), bad.alias("corrupt"), F.coalesce(F.try_divide(bad, F.count("*")), F.lit(0.0)).alias("share"))


def live(snapshots: DataFrame, column: str = "snapshot", now: str = "now", keep: tuple[str, ...] = ()) -> DataFrame:
    """Aircraft of live snapshots with a position no older than a minute; now: column of epoch seconds. With `keep`, these columns and `at`, the place in the answer, come along."""
    doc = snapshots.select(*keep, F.col(now).cast("double").alias("now"), F.try_variant_get(F.try_parse_json(column), "$.ac", "array<variant>").alias("all"))
    v = doc.select(*keep, "now", F.posexplode("all").alias("at", "a"))
    get = lambda name, kind: F.try_variant_get("a", f"$.{name}", kind)
    seen = F.coalesce(get("seen_pos", "double"), F.lit(0.0))
    v = v.withColumns({"lat": get("lat", "double"), "lon": get("lon", "double"), "seen": seen}).where(f"lat is not null and lon is not null and seen <= {MAX_DETAIL_AGE_S}")
    null = lambda name: F.lit(None).cast("float").alias(name)
    return v.select(
        F.timestamp_millis(F.floor((F.col("now") - F.col("seen")) * 1000)).alias("ts"), F.lower(get("hex", "string")).alias("icao24"), "lat", "lon", F.try_variant_get("a", "$.alt_baro", "float").alias("alt_baro_ft"), get("alt_geom", "float").alias("alt_geom_ft"), null("gs_kt"), null("track"),
        F.nullif(F.trim(get("flight", "string")), F.lit("")).alias("callsign"), *(get(n, "int").cast("tinyint").alias(n) for n in ("nic", "nac_p", "sil")), null("nic_age_s"), F.concat(F.lit("adsblol:"), F.coalesce(get("type", "string"), F.lit("unknown"))).alias("source"),
        F.coalesce(get("alt_baro", "string") == "ground", F.lit(False)).alias("on_ground"), (F.coalesce(get("dbFlags", "int"), F.lit(0)).bitwiseAND(F.lit(12)) != 0).alias("anonymous"), *keep, *(["at"] if keep else []),
    )


def gate(documents: DataFrame, limit: float = MAX_CORRUPT_SHARE, column: str = "document") -> None:
    """Raises where more than `limit` of the documents are no JSON: such a day fails as a whole."""
    r = corrupt_share(documents, column).first()
    if r.share > limit:
        raise ValueError(f"{r.corrupt} of {r.documents} documents are damaged")


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Captured positions, one JSON object a line, gzip or plain."""
    return spark.read.schema(POSITIONS).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*").json(path)


def write_json_lines(positions: DataFrame, folder: str) -> None:
    """Adds positions to a folder of captured ones."""
    positions.write.mode("append").option("compression", "gzip").json(folder)
