"""Metric tables: the reference's gauges and exporters as long DataFrames.

A sample is ``(metric string, labels map<string,string>, ts timestamp,
value double[, ok boolean])``.  Maps cannot be grouped on in Spark, so
grouping uses the label entries sorted by key (an array of structs, which
is orderable) and rebuilds the map afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.session import materialise

# Gauge names of the weather exporter and the JSON field each
# one reads (missing fields count as 0).
WEATHER_GAUGES = [
    ("owm_temperature_celsius", "main.temp"),
    ("owm_feels_like_celsius", "main.feels_like"),
    ("owm_humidity_percent", "main.humidity"),
    ("owm_pressure_hpa", "main.pressure"),
    ("owm_wind_speed_ms", "wind.speed"),
    ("owm_clouds_percent", "clouds.all"),
    ("owm_visibility_m", "visibility"),
    ("owm_rain_1h_mm", "rain.1h"),
    ("owm_snow_1h_mm", "snow.1h"),
]

WEATHER_SCHEMA = T.StructType([
    T.StructField("main", T.StructType([T.StructField(n, T.DoubleType()) for n in
                                        ("temp", "feels_like", "humidity", "pressure")])),
    T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
    T.StructField("clouds", T.StructType([T.StructField("all", T.DoubleType())])),
    T.StructField("rain", T.StructType([T.StructField("1h", T.DoubleType())])),
    T.StructField("snow", T.StructType([T.StructField("1h", T.DoubleType())])),
    T.StructField("visibility", T.DoubleType()),
])


_CORRUPT = "_corrupt_body"


def label_key(labels: Column) -> Column:
    """Orderable, groupable form of a label map (entries sorted by key)."""
    return F.array_sort(F.map_entries(labels))


def weather_to_metrics(df: DataFrame, city: str = "city", ts: str = "ts",
                       body: str = "body", ok: str | None = "ok") -> DataFrame:
    """JSON weather responses → nine gauges per city; missing fields → 0.

    Rows whose fetch failed (``ok`` false, or a body that does not parse)
    produce samples with ok = false, so ``latest_gauges`` keeps the previous
    value for that city.
    """
    parsed = df.withColumn("_w", F.from_json(
        F.col(body), T.StructType([*WEATHER_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())]),
        {"columnNameOfCorruptRecord": _CORRUPT}))
    # a body that does not parse gives a struct of nulls and the body itself
    good = F.col("_w").isNotNull() & F.col(f"_w.{_CORRUPT}").isNull()
    if ok is not None:
        good = good & F.coalesce(F.col(ok), F.lit(False))
    def field(path: str) -> Column:
        c = F.col("_w")
        for part in path.split("."):
            c = c.getField(part)
        return c
    gauges = F.array(*[F.struct(F.lit(name).alias("metric"),
                                F.coalesce(field(path), F.lit(0.0)).alias("value"))
                       for name, path in WEATHER_GAUGES])
    return (parsed.select(F.col(ts).alias("ts"), F.col(city).alias("_city"),
                          good.alias("ok"), F.explode(gauges).alias("g"))
            .select(F.col("g.metric").alias("metric"),
                    F.create_map(F.lit("city"), F.col("_city")).alias("labels"),
                    "ts", F.col("g.value").alias("value"), "ok"))


def latest_gauges(samples: DataFrame) -> DataFrame:
    """Last successful value per (metric, label set): gauge semantics.

    Failed samples (ok = false) are ignored, so a failed scrape leaves the
    previous value in place.  Ties on ts are broken by the larger value.

    The largest ts of each series is found first, by a hash aggregate that holds
    one number per series and task; ``max_by`` over whole samples, which sorts
    its input, then only sees the samples of those times.
    """
    s = samples
    if "ok" in s.columns:
        s = s.where(F.col("ok"))
    keyed = s.select(F.col("metric").alias("_m"), label_key(F.col("labels")).alias("_k"), "ts")
    # written, so its size is known: few series are broadcast, many are joined by a shuffle
    newest = materialise(keyed.groupBy("_m", "_k").agg(F.max("ts").alias("_ts")), "latest-times")
    s = s.join(newest, F.col("metric").eqNullSafe(F.col("_m")) & F.col("ts").eqNullSafe(F.col("_ts"))
               & label_key(F.col("labels")).eqNullSafe(F.col("_k")), "left_semi")
    latest = F.max_by(F.struct("ts", "value", "labels"), F.struct("ts", "value"))
    return (s.groupBy("metric", label_key(F.col("labels")).alias("_lk"))
            .agg(latest.alias("_l"))
            .select("metric", F.col("_l.labels").alias("labels"),
                    F.col("_l.ts").alias("ts"), F.col("_l.value").alias("value")))


def api_health(samples: DataFrame, round_col: str) -> DataFrame:
    """Per scrape round: up = 1 if every sample succeeded, last update = max ts.

    The last-update time is set even when the round failed, as in the
    reference exporter.
    """
    return (samples.groupBy(round_col)
            .agg(F.bool_and("ok").cast("int").alias("up"), F.max("ts").alias("last_update")))


def query_to_metrics(df: DataFrame, labels: Sequence[str], gauges: Sequence[str],
                     prefix: str = "") -> DataFrame:
    """Result rows → samples: LABEL columns become the label map, GAUGE
    columns become one sample each (``unpivot``)."""
    keyed = df.select(
        F.create_map(*[x for c in labels for x in (F.lit(c), F.col(c).cast("string"))]).alias("labels")
        if labels else F.create_map().cast("map<string,string>").alias("labels"),
        *[F.col(g).cast("double").alias(g) for g in gauges])
    long = keyed.unpivot("labels", list(gauges), "metric", "value")
    return long.select(F.concat(F.lit(prefix), F.col("metric")).alias("metric"), "labels", "value")


def relabel(samples: DataFrame, source_label: str, target_label: str,
            replacement: str) -> DataFrame:
    """Scrape relabelling: where ``source_label`` is present, set
    ``target_label`` to the constant ``replacement`` (overwriting it)."""
    labels = F.col("labels")
    has_source = F.map_contains_key(labels, F.lit(source_label))
    replaced = F.map_concat(F.map_filter(labels, lambda k, v: k != F.lit(target_label)),
                            F.create_map(F.lit(target_label), F.lit(replacement)))
    return samples.withColumn("labels", F.when(has_source, replaced).otherwise(labels))


def info_metric(spark: SparkSession, name: str, labels: Mapping[str, str],
                cities: Sequence[str] = ()) -> DataFrame:
    """A constant info metric: value 1 with a fixed label set; ``cities``
    (the exporter's configured cities) become one comma-joined label."""
    all_labels = dict(labels)
    if cities:
        all_labels["cities"] = ",".join(cities)
    return spark.createDataFrame([(name, all_labels, 1.0)],
                                 "metric string, labels map<string,string>, value double")


def resample_last(samples: DataFrame, step: str = "15 seconds") -> DataFrame:
    """One value per series per fixed step: the last sample of the step."""
    w = F.window("ts", step)
    last = F.max_by(F.struct("ts", "value", "labels"), F.struct("ts", "value"))
    return (samples.groupBy("metric", label_key(F.col("labels")).alias("_lk"), w.alias("w"))
            .agg(last.alias("_l"))
            .select(F.col("w.start").alias("step_start"), "metric",
                    F.col("_l.labels").alias("labels"), F.col("_l.value").alias("value")))


# ------------------------------------------------------ text exposition format
_LINE = r"^([a-zA-Z_:][a-zA-Z0-9_:]*)(\{(.*)\})?\s+(\S+)(\s+(-?\d+))?\s*$"
_PAIR = r'([a-zA-Z_][a-zA-Z0-9_]*)\s*=\s*"((?:[^"\\]|\\.)*)"'


def _unescape(v: Column) -> Column:
    """Label value as written: ``\\n`` is a line end, any other escaped
    character itself (escaped backslashes are set aside meanwhile)."""
    aside = F.replace(v, F.lit("\\\\"), F.lit("\0"))
    ends = F.replace(aside, F.lit("\\n"), F.lit("\n"))
    return F.replace(F.regexp_replace(ends, r"\\(.)", "$1"), F.lit("\0"), F.lit("\\"))


def parse_exposition(lines: DataFrame, col: str = "value") -> DataFrame:
    """``name{k="v",...} value [ts_ms]`` lines → samples; comments and blanks
    skipped; a value that is not a number becomes NULL.  A column ``ts`` of
    ``lines`` is the time of the lines that do not give one."""
    line = F.trim(F.col(col))
    data = lines.where((line != "") & ~line.startswith("#"))
    name = F.regexp_extract(line, _LINE, 1)
    raw_labels = F.regexp_extract(line, _LINE, 3)
    # key="value" pairs; a quoted value may contain commas, '=' and \" escapes
    keys = F.regexp_extract_all(raw_labels, F.lit(_PAIR), 1)
    values = F.transform(F.regexp_extract_all(raw_labels, F.lit(_PAIR), 2),
                         _unescape)
    entries = F.arrays_zip(keys.alias("key"), values.alias("value"))
    number = F.regexp_extract(line, _LINE, 4)
    own_time = F.timestamp_millis(F.regexp_extract(line, _LINE, 6).try_cast("long"))
    extra = [F.coalesce(own_time, F.col(c)).alias(c) if c == "ts" else F.col(c)
             for c in lines.columns if c != col]
    return data.select(
        name.alias("metric"),
        F.map_from_entries(entries).alias("labels"),
        number.try_cast("double").alias("value"),
        *extra,
    ).where(F.col("metric") != "")


def to_exposition(samples: DataFrame, help_text: Mapping[str, str] | None = None,
                  kind: str = "gauge") -> DataFrame:
    """Samples → exposition lines (one string column ``value``), with HELP and
    TYPE lines per metric; write with ``df.write.text``.  Samples with a ``ts``
    carry it in milliseconds."""
    def quoted(v):  # escape backslashes, quotes and line ends inside a label value
        return F.replace(F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')),
                         F.lit("\n"), F.lit("\\n"))
    lab = F.array_join(F.transform(label_key(F.col("labels")),
                                   lambda e: F.format_string('%s="%s"', e["key"], quoted(e["value"]))), ",")
    body = F.concat(F.col("metric"), F.when(F.size("labels") > 0, F.concat(F.lit("{"), lab, F.lit("}")))
                    .otherwise(F.lit("")), F.lit(" "), F.col("value").cast("string"))
    if "ts" in samples.columns:
        millis = F.unix_millis(F.col("ts").cast("timestamp"))
        body = F.concat(body, F.when(F.col("ts").isNull(), "").otherwise(F.concat(F.lit(" "), millis)))
    helps = F.create_map(*[x for k, v in (help_text or {}).items() for x in (F.lit(k), F.lit(v))]) \
        if help_text else None
    header = samples.select("metric").distinct()
    help_line = F.concat(F.lit("# HELP "), F.col("metric"), F.lit(" "),
                         F.coalesce(helps[F.col("metric")], F.lit("")) if helps is not None else F.lit(""))
    lines = (header.select("metric", F.lit(0).alias("o"), help_line.alias("value"))
             .unionByName(header.select("metric", F.lit(1).alias("o"),
                                        F.concat(F.lit("# TYPE "), F.col("metric"), F.lit(f" {kind}")).alias("value")))
             .unionByName(samples.select("metric", F.lit(2).alias("o"), body.alias("value"))))
    return lines.orderBy("metric", "o", "value").select("value")
