"""Every operator and report as a query over the test tables, with SQL that must agree.

A query takes (spark, directory of the tables) and returns a DataFrame. The SQL runs on the
same tables in another engine. Averages are rounded there through DECIMAL, because Spark
rounds the decimal text of a double half up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import binding
from tarmac.functions.delays import delay_band, reason_label
from tarmac.functions.months import month_name, month_names
from tarmac.model import CAUSE_LABELS, DELAY_CAUSES, FLIGHTS, FLIGHTS_RAW, MONTH_NAMES
from tarmac.operators import cleaning, measures, ranking, subsets
from tarmac.plans import airport, carrier, prepare, quality, states
from tarmac.sources import reading, writing
from tarmac.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# --- SQL building blocks --------------------------------------------------------------

_CLEAN = """
SELECT month, trim(upper(op_unique_carrier), ' ' || chr(9)) AS op_unique_carrier,
  trim(upper(origin), ' ' || chr(9)) AS origin,
  dep_delay, arr_delay, cancelled,
  CASE WHEN cancelled = 0 THEN NULL
       WHEN cancellation_code IN ('A', 'B', 'C', 'D') THEN cancellation_code END AS cancellation_code,
  CASE WHEN cancelled = 0 THEN coalesce(carrier_delay, 0) END AS carrier_delay,
  CASE WHEN cancelled = 0 THEN coalesce(weather_delay, 0) END AS weather_delay,
  CASE WHEN cancelled = 0 THEN coalesce(nas_delay, 0) END AS nas_delay,
  CASE WHEN cancelled = 0 THEN coalesce(security_delay, 0) END AS security_delay,
  CASE WHEN cancelled = 0 THEN coalesce(late_aircraft_delay, 0) END AS late_aircraft_delay,
  CASE cancellation_code WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather' WHEN 'C' THEN 'NAS'
       WHEN 'D' THEN 'Security' ELSE 'Not Cancelled' END AS cancellation_reason
FROM flights_raw
WHERE month IS NOT NULL AND op_unique_carrier IS NOT NULL AND origin IS NOT NULL
  AND cancelled IS NOT NULL AND diverted IS NOT NULL AND diverted = 0
  AND (cancelled = 1 OR (dep_delay IS NOT NULL AND arr_delay IS NOT NULL))
  AND month BETWEEN 1 AND 12 AND trim(op_unique_carrier, ' ' || chr(9)) <> '' AND trim(origin, ' ' || chr(9)) <> ''"""

_RAW_CTE = f"flights_raw AS (SELECT {', '.join(binding.select_list(binding.RAW_COLUMNS))} FROM lineitem)"
_TEXT_CTE = f"flights_text AS (SELECT {', '.join(binding.select_list(binding.TEXT_COLUMNS))} FROM lineitem)"
_NAMES = "[" + ", ".join(f"'{name}'" for name in MONTH_NAMES) + "]"
_MONTHS = f"list_transform(list_sort(list(DISTINCT month)), lambda m: {_NAMES}[m])"


def _on_raw(select: str) -> str:
    return f"WITH {_RAW_CTE} {select}"


def _on_clean(select: str, more: str = "") -> str:
    return f"WITH {_RAW_CTE}, flights AS ({_CLEAN}){more} {select}"


def _on_text(select: str) -> str:
    return f"WITH {_TEXT_CTE} {select}"


def _rounded(value: str, places: int = 2) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38, 12)), {places}) AS DOUBLE)"


# --- Registration ---------------------------------------------------------------------


def _register(name: str, run: Query, sql: str | None = None) -> None:
    QUERIES[name] = run
    if sql is not None:
        ORACLE[name] = sql


def _raw(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(binding.flights_raw(spark, sf_dir))


def _clean(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(binding.flights(spark, sf_dir))


def _text(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(binding.flights_text(spark, sf_dir))


def _per(*keys: str, columns) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.groupBy(*keys).agg(*columns())


def _joined_months(df: DataFrame) -> DataFrame:
    return df.withColumn("months", F.array_join("months", ","))


# --- Sources and sinks ----------------------------------------------------------------


def _csv_scan(spark, sf_dir):
    path = scratch_path(spark, "raw") + ".csv"
    writing.write_csv(binding.flights_raw(spark, sf_dir), path)
    return reading.scan_csv(spark, path)


def _text_file(spark, sf_dir) -> str:
    path = scratch_path(spark, "text") + ".csv"
    writing.write_csv(binding.flights_text(spark, sf_dir), path)
    return path


def _csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "clean") + ".csv"
    writing.write_csv(binding.flights(spark, sf_dir), path)
    return reading.read_flights(spark, path)


def _csv_file_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "clean") + ".csv"
    writing.write_csv_file(binding.flights(spark, sf_dir), path)
    return reading.read_flights(spark, path)


def _mixed_header_scan(spark, sf_dir):
    """The raw flights from one folder of files with their columns in three orders."""
    raw, path = binding.flights_raw(spark, sf_dir), scratch_path(spark, "mixed")
    names = raw.columns
    early, late = F.coalesce(F.col("month") <= 4, F.lit(False)), F.coalesce(F.col("month") > 8, F.lit(False))
    writing.write_csv(raw.filter(early), f"{path}/first")
    writing.write_csv(raw.filter(late).select(*reversed(names)), f"{path}/second")
    middle = raw.filter(~early & ~late).select(*names[5:], F.lit("x").alias("more"), *names[:5])
    writing.write_csv(middle.toDF(*(name.upper() for name in middle.columns)), f"{path}/third")
    return reading.scan_csv(spark, path)


def _reread_report(spark, report: DataFrame) -> DataFrame:
    path = scratch_path(spark, "report")
    writing.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


def _number_sql(cell: str) -> str:
    return f"TRY_CAST({cell} AS DOUBLE)"


_NUMBERS = ("dep_delay", "arr_delay", *DELAY_CAUSES)
_IS_MONTH = f"({_number_sql('month')} IS NOT NULL AND {_number_sql('month')} = floor({_number_sql('month')}))"
_IS_KEPT = " AND ".join(
    [
        "month IS DISTINCT FROM 'month'",
        _IS_MONTH,
        f"{_number_sql('cancelled')} IS NOT NULL",
        *(f"(coalesce(trim({c}), '') = '' OR {_number_sql(c)} IS NOT NULL)" for c in _NUMBERS),
    ]
)
_TYPED = f"""SELECT CAST({_number_sql('month')} AS INT) AS month,
  nullif(trim(op_unique_carrier, ' ' || chr(9)), '') AS op_unique_carrier, nullif(trim(origin, ' ' || chr(9)), '') AS origin,
  {_number_sql('dep_delay')} AS dep_delay, {_number_sql('arr_delay')} AS arr_delay,
  CAST(trunc({_number_sql('cancelled')}) AS INT) AS cancelled, cancellation_code,
  {', '.join(f'{_number_sql(c)} AS {c}' for c in DELAY_CAUSES)}, cancellation_reason
  FROM flights_text WHERE {_IS_KEPT}"""

_register("csv_scan", _csv_scan, _on_raw("SELECT * FROM flights_raw"))
_register(
    "tolerant_parse",
    lambda spark, sf_dir: reading.scan_tolerant(spark, _text_file(spark, sf_dir)),
    _on_text(_TYPED),
)
_register(
    "positional_scan",
    lambda spark, sf_dir: reading.scan_positional(spark, _text_file(spark, sf_dir)),
    _on_text(_TYPED),
)
_register(
    "scan_report",
    lambda spark, sf_dir: reading.scan_report(spark, _text_file(spark, sf_dir)),
    _on_text(
        f"""SELECT CASE WHEN month = 'month' THEN 'header' WHEN {_IS_KEPT} THEN 'kept'
        ELSE 'malformed' END AS status, count(*) AS lines FROM flights_text GROUP BY 1"""
    ),
)
_register("csv_roundtrip", _csv_roundtrip, _on_clean("SELECT * FROM flights"))
_register("csv_file_roundtrip", _csv_file_roundtrip, _on_clean("SELECT * FROM flights"))
_register("mixed_header_scan", _mixed_header_scan, _on_raw("SELECT * FROM flights_raw"))

# --- Cleaning steps -------------------------------------------------------------------

_register(
    "select_columns",
    lambda spark, sf_dir: cleaning.select_columns(
        binding.lineitem(spark, sf_dir).selectExpr("*", *binding.select_list(binding.RAW_COLUMNS))
    ),
    _on_raw(f"SELECT {', '.join(FLIGHTS_RAW.names)} FROM flights_raw"),
)
_register("drop_column", _raw(cleaning.drop_column), _on_raw("SELECT * EXCLUDE (diverted) FROM flights_raw"))
_register(
    "cast_columns",
    _text(lambda df: cleaning.cast_columns(df).select("month", "arr_delay", "cancelled")),
    _on_text(
        f"""SELECT CASE WHEN {_IS_MONTH} THEN CAST({_number_sql('month')} AS INT) END AS month,
        {_number_sql('arr_delay')} AS arr_delay,
        CAST(trunc({_number_sql('cancelled')}) AS INT) AS cancelled FROM flights_text"""
    ),
)
_register(
    "drop_null_mandatory",
    _raw(cleaning.drop_null_mandatory),
    _on_raw(
        """SELECT * FROM flights_raw WHERE month IS NOT NULL AND op_unique_carrier IS NOT NULL
        AND origin IS NOT NULL AND cancelled IS NOT NULL AND diverted IS NOT NULL"""
    ),
)
_register("exclude_diverted", _raw(cleaning.exclude_diverted), _on_raw("SELECT * FROM flights_raw WHERE diverted = 0"))
_register(
    "require_delays_if_operated",
    _raw(cleaning.require_delays_if_operated),
    _on_raw(
        """SELECT * FROM flights_raw
        WHERE cancelled = 1 OR (dep_delay IS NOT NULL AND arr_delay IS NOT NULL)"""
    ),
)
_register(
    "zero_fill_causes",
    _raw(cleaning.zero_fill_causes),
    _on_raw(
        f"""SELECT * EXCLUDE ({', '.join(DELAY_CAUSES)}),
        {', '.join(f'CASE WHEN cancelled = 0 THEN coalesce({c}, 0) END AS {c}' for c in DELAY_CAUSES)}
        FROM flights_raw"""
    ),
)
_register("valid_month", _raw(cleaning.valid_month), _on_raw("SELECT * FROM flights_raw WHERE month BETWEEN 1 AND 12"))
_register(
    "normalize_strings",
    _raw(lambda df: cleaning.normalize_strings(df).select("op_unique_carrier", "origin")),
    _on_raw(
        """SELECT trim(upper(op_unique_carrier), ' ' || chr(9)) AS op_unique_carrier,
        trim(upper(origin), ' ' || chr(9)) AS origin FROM flights_raw"""
    ),
)
_register(
    "drop_empty_keys",
    _text(cleaning.drop_empty_keys),
    _on_text("SELECT * FROM flights_text WHERE trim(op_unique_carrier, ' ' || chr(9)) <> '' AND trim(origin, ' ' || chr(9)) <> ''"),
)
_register(
    "validate_codes",
    _raw(lambda df: cleaning.validate_codes(df).select("cancelled", "cancellation_code")),
    _on_raw(
        """SELECT cancelled, CASE WHEN cancellation_code IN ('A', 'B', 'C', 'D') THEN cancellation_code END
        AS cancellation_code FROM flights_raw"""
    ),
)
_register(
    "map_reason",
    _raw(lambda df: cleaning.map_reason(df).select("cancellation_code", "cancellation_reason")),
    _on_raw(
        """SELECT cancellation_code, CASE cancellation_code WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather'
        WHEN 'C' THEN 'NAS' WHEN 'D' THEN 'Security' ELSE 'Not Cancelled' END AS cancellation_reason
        FROM flights_raw"""
    ),
)
_register(
    "nullify_code_operated",
    _raw(lambda df: cleaning.nullify_code_operated(df).select("cancelled", "cancellation_code")),
    _on_raw(
        """SELECT cancelled, CASE WHEN cancelled = 0 THEN NULL ELSE cancellation_code END
        AS cancellation_code FROM flights_raw"""
    ),
)
_register("clean_flights", binding.flights, _on_clean("SELECT * FROM flights"))

# --- Values of a single flight --------------------------------------------------------

_BAND = """CASE WHEN cancelled = 0 AND dep_delay < 15 THEN 'low'
  WHEN cancelled = 0 AND dep_delay BETWEEN 15 AND 60 THEN 'medium'
  WHEN cancelled = 0 AND dep_delay > 60 THEN 'high' END"""
_CAUSES = """causes AS (
  SELECT origin, month, 'Canc_' || cancellation_reason AS cause FROM flights
    WHERE cancelled = 1 AND cancellation_reason <> 'Not Cancelled'
  UNION ALL SELECT origin, month, 'Delay_Carrier' FROM flights WHERE cancelled = 0 AND carrier_delay > 0
  UNION ALL SELECT origin, month, 'Delay_Weather' FROM flights WHERE cancelled = 0 AND weather_delay > 0
  UNION ALL SELECT origin, month, 'Delay_NAS' FROM flights WHERE cancelled = 0 AND nas_delay > 0
  UNION ALL SELECT origin, month, 'Delay_Security' FROM flights WHERE cancelled = 0 AND security_delay > 0
  UNION ALL SELECT origin, month, 'Delay_LateAircraft' FROM flights
    WHERE cancelled = 0 AND late_aircraft_delay > 0)"""

_register(
    "delay_band",
    _raw(lambda df: df.select("cancelled", "dep_delay", delay_band().alias("band"))),
    _on_raw(f"SELECT cancelled, dep_delay, {_BAND} AS band FROM flights_raw"),
)
_register(
    "explode_causes",
    _clean(lambda df: ranking.explode_causes(df, "origin", "month")),
    _on_clean("SELECT origin, month, cause FROM causes", f", {_CAUSES}"),
)
_register(
    "label_concat",
    _clean(lambda df: df.select("cancelled", reason_label(F.col("cancellation_reason")).alias("label"))),
    _on_clean("SELECT cancelled, 'Canc_' || cancellation_reason AS label FROM flights"),
)
_register(
    "month_names",
    _raw(lambda df: df.select("month", month_name(F.col("month")).alias("month_name"))),
    _on_raw(f"SELECT month, {_NAMES}[month] AS month_name FROM flights_raw"),
)
_register(
    "composite_key",
    _clean(lambda df: df.groupBy(F.concat_ws("|", "origin", "month").alias("key")).agg(measures.flight_count())),
    _on_clean("SELECT origin || '|' || month AS key, count(*) AS num_flights FROM flights GROUP BY 1"),
)

# --- Measures per carrier and airport -------------------------------------------------

_PAIR = ("op_unique_carrier", "origin")
_PAIR_SQL = "SELECT op_unique_carrier, origin, {} FROM flights GROUP BY op_unique_carrier, origin"
_RATE = _rounded("CAST(sum(cancelled) AS DOUBLE) / count(*)", 4)
_STATS = f"""count(*) AS num_flights,
  {_rounded('min(arr_delay)')} AS arr_delay_min, {_rounded('max(arr_delay)')} AS arr_delay_max,
  {_rounded('avg(arr_delay)')} AS arr_delay_avg, {_RATE} AS cancellation_rate"""

for _name, _measure, _sql in (
    ("flights_per_carrier_origin", measures.flight_count, "count(*) AS num_flights"),
    ("arr_delay_min", measures.arr_delay_min, f"{_rounded('min(arr_delay)')} AS arr_delay_min"),
    ("arr_delay_max", measures.arr_delay_max, f"{_rounded('max(arr_delay)')} AS arr_delay_max"),
    ("arr_delay_avg", measures.arr_delay_avg, f"{_rounded('avg(arr_delay)')} AS arr_delay_avg"),
    ("cancellation_rate", measures.cancellation_rate, f"{_RATE} AS cancellation_rate"),
):
    _register(_name, _clean(_per(*_PAIR, columns=lambda m=_measure: [m()])), _on_clean(_PAIR_SQL.format(_sql)))

_register(
    "active_months",
    _clean(
        lambda df: df.groupBy(*_PAIR)
        .agg(measures.active_months())
        .withColumn("months", F.array_join(month_names(F.col("months")), ","))
    ),
    _on_clean(_PAIR_SQL.format(f"array_to_string({_MONTHS}, ',') AS months")),
)
_register(
    "rounded_measures",
    _clean(
        lambda df: df.groupBy("op_unique_carrier").agg(
            F.round(F.avg("dep_delay"), 2).alias("dep_delay_avg"),
            measures.arr_delay_avg(),
            measures.cancellation_rate(),
        )
    ),
    _on_clean(
        f"""SELECT op_unique_carrier, {_rounded('avg(dep_delay)')} AS dep_delay_avg,
        {_rounded('avg(arr_delay)')} AS arr_delay_avg, {_RATE} AS cancellation_rate
        FROM flights GROUP BY op_unique_carrier"""
    ),
)
_CARRIER_SQL = _on_clean(_PAIR_SQL.format(f"{_STATS}, array_to_string({_MONTHS}, ',') AS months"))
_register("carrier_airport_stats", _clean(lambda df: _joined_months(carrier.carrier_airport_stats(df))), _CARRIER_SQL)
_register(
    "nested_carrier_report",
    _clean(lambda df: _joined_months(carrier.flatten_carrier_report(carrier.nested_carrier_report(df)))),
    _CARRIER_SQL,
)


def _merged_states(spark, sf_dir, kind, half) -> DataFrame:
    """States of two halves of the raw flights, stored as batches and read together."""
    raw, path = binding.flights_raw(spark, sf_dir), scratch_path(spark, "states")
    states.add_batch(states.states_of_raw(raw.filter(half), kind), path, "first")
    states.add_batch(states.states_of_raw(raw.filter(~F.coalesce(half, F.lit(False))), kind), path, "second")
    return states.stored(spark, path, kind)


_register(
    "merged_carrier_states",
    lambda spark, sf_dir: _joined_months(
        states.carrier_airport_stats(_merged_states(spark, sf_dir, states.CARRIER, F.col("month") <= 6))
    ),
    _CARRIER_SQL,
)
_register(
    "report_json_lines",
    _clean(lambda df: carrier.nested_carrier_report(df).transform(lambda r: r.select(writing.report_line(r)))),
    _on_clean(
        """SELECT CAST(to_json(struct_pack(carrier := op_unique_carrier, airports := list(
          struct_pack(airport := origin, data := struct_pack(num_flights := num_flights,
            arr_delay_min := arr_delay_min, arr_delay_max := arr_delay_max, arr_delay_avg := arr_delay_avg,
            cancellation_rate := cancellation_rate, months := months)) ORDER BY origin))) AS VARCHAR) AS line
        FROM stats GROUP BY op_unique_carrier""",
        f", stats AS ({_PAIR_SQL.format(f'{_STATS}, {_MONTHS} AS months')})",
    ),
)
_register(
    "json_report_roundtrip",
    lambda spark, sf_dir: _joined_months(
        carrier.flatten_carrier_report(
            _reread_report(spark, carrier.nested_carrier_report(binding.flights(spark, sf_dir)))
        )
    ),
    _CARRIER_SQL,
)



def _reread_document(spark, report: DataFrame) -> DataFrame:
    path = scratch_path(spark, "report") + ".json"
    writing.write_report_file(report, path)
    return spark.read.schema(report.schema).option("multiLine", True).json(path)


_register(
    "json_document_roundtrip",
    lambda spark, sf_dir: _joined_months(
        carrier.flatten_carrier_report(
            _reread_document(spark, carrier.nested_carrier_report(binding.flights(spark, sf_dir)))
        )
    ),
    _CARRIER_SQL,
)

# --- Measures per airport and month ---------------------------------------------------

_MONTHLY_SQL = "SELECT origin, month, {} FROM banded GROUP BY origin, month"
_BANDED = f", banded AS (SELECT *, {_BAND} AS band FROM flights)"


def _band_sql(template: str) -> str:
    return ", ".join(template.format(b=band) for band in ("low", "medium", "high"))


_BAND_COUNTS = _band_sql("count(*) FILTER (band = '{b}') AS {b}_count")
_BAND_SUMS = _band_sql(
    "coalesce(sum(dep_delay) FILTER (band = '{b}'), 0) AS {b}_dep_sum, "
    "coalesce(sum(arr_delay) FILTER (band = '{b}'), 0) AS {b}_arr_sum"
)
_BAND_MEANS = ", ".join(
    _rounded(
        f"coalesce(sum({side}_delay) FILTER (band = '{b}'), 0) / nullif(count(*) FILTER (band = '{b}'), 0)"
    )
    + f" AS {b}_avg_{side}_delay"
    for b in ("low", "medium", "high")
    for side in ("dep", "arr")
)
_DELAY_LABELS = tuple(DELAY_CAUSES.values())
_CANCEL_LABELS = tuple(label for label in CAUSE_LABELS if label not in _DELAY_LABELS)


def _cause_columns(labels, gate_cancelled: bool = True) -> list:
    return [c for label, c in zip(CAUSE_LABELS, measures.cause_counts(gate_cancelled)) if label in labels]


def _cancel_sql(gate: str) -> str:
    return ", ".join(
        f"count(*) FILTER ({gate}cancellation_reason = '{r}') AS \"Canc_{r}\""
        for r in ("Carrier", "Weather", "NAS", "Security")
    )


_register(
    "band_counts",
    _clean(_per(*airport.KEYS, columns=measures.band_counts)),
    _on_clean(_MONTHLY_SQL.format(_BAND_COUNTS), _BANDED),
)
_register(
    "band_sums",
    _clean(_per(*airport.KEYS, columns=measures.band_sums)),
    _on_clean(_MONTHLY_SQL.format(_BAND_SUMS), _BANDED),
)
_register(
    "band_averages",
    _clean(
        lambda df: airport.airport_month_bands(df).select(
            *airport.KEYS,
            *(f"{b}_avg_{side}_delay" for b in ("low", "medium", "high") for side in ("dep", "arr")),
        )
    ),
    _on_clean(_MONTHLY_SQL.format(_BAND_MEANS), _BANDED),
)
_register(
    "delay_cause_counts",
    _clean(_per(*airport.KEYS, columns=lambda: _cause_columns(_DELAY_LABELS))),
    _on_clean(
        "SELECT origin, month, "
        + ", ".join(
            f'count(*) FILTER (cancelled = 0 AND {column} > 0) AS "{label}"'
            for column, label in DELAY_CAUSES.items()
        )
        + " FROM flights GROUP BY origin, month"
    ),
)
_register(
    "cancel_reason_counts",
    _clean(_per(*airport.KEYS, columns=lambda: _cause_columns(_CANCEL_LABELS))),
    _on_clean(f"SELECT origin, month, {_cancel_sql('cancelled = 1 AND ')} FROM flights GROUP BY origin, month"),
)
_register(
    "cancel_reason_counts_ungated",
    _clean(_per(*airport.KEYS, columns=lambda: _cause_columns(_CANCEL_LABELS, gate_cancelled=False))),
    _on_clean(f"SELECT origin, month, {_cancel_sql('')} FROM flights GROUP BY origin, month"),
)
_BANDS_SQL = _on_clean(_MONTHLY_SQL.format(f"{_BAND_COUNTS}, {_BAND_MEANS}"), _BANDED)
_NAMED_BANDS_SQL = _on_clean(
    f"""SELECT * REPLACE ({_NAMES}[month] AS month)
    FROM ({_MONTHLY_SQL.format(f'{_BAND_COUNTS}, {_BAND_MEANS}')})""",
    _BANDED,
)
_RANKED = f""", {_CAUSES},
  counted AS (SELECT origin, month, cause, count(*) AS count FROM causes GROUP BY origin, month, cause),
  ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY origin, month ORDER BY count DESC,
    list_position([{', '.join(f"'{label}'" for label in CAUSE_LABELS)}], cause)) AS INT) AS rank FROM counted)"""
_CAUSES_SQL = _on_clean("SELECT origin, month, rank, cause, count FROM ranked WHERE rank <= 3", _RANKED)
_NAMED_CAUSES_SQL = _on_clean(
    f"SELECT origin, {_NAMES}[month] AS month, rank, cause, count FROM ranked WHERE rank <= 3", _RANKED
)
_register("airport_month_bands", _clean(airport.airport_month_bands), _BANDS_SQL)
_register(
    "merged_airport_states",
    lambda spark, sf_dir: states.airport_month_bands(
        _merged_states(spark, sf_dir, states.AIRPORT, F.col("arr_delay") < 30)
    ),
    _BANDS_SQL,
)
_register("top_causes", _clean(airport.top_causes), _CAUSES_SQL)
_register("top_causes_window", _clean(ranking.top_causes_by_window), _CAUSES_SQL)
_register(
    "nested_airport_report",
    _clean(lambda df: airport.flatten_airport_bands(airport.nested_airport_report(df))),
    _NAMED_BANDS_SQL,
)
_register(
    "nested_airport_causes",
    _clean(lambda df: airport.flatten_airport_causes(airport.nested_airport_report(df))),
    _NAMED_CAUSES_SQL,
)
_register(
    "json_airport_roundtrip",
    lambda spark, sf_dir: airport.flatten_airport_causes(
        _reread_report(spark, airport.nested_airport_report(binding.flights(spark, sf_dir)))
    ),
    _NAMED_CAUSES_SQL,
)

# --- Quality report -------------------------------------------------------------------

_FUNNEL = """
  SELECT count(*) AS raw, count(*) FILTER (s1) AS a, count(*) FILTER (s1 AND s2) AS b,
    count(*) FILTER (s1 AND s2 AND s3) AS c, count(*) FILTER (s1 AND s2 AND s3 AND s4) AS d,
    count(*) FILTER (s1 AND s2 AND s3 AND s4 AND s5) AS e
  FROM (SELECT month IS NOT NULL AND op_unique_carrier IS NOT NULL AND origin IS NOT NULL
      AND cancelled IS NOT NULL AND diverted IS NOT NULL AS s1, diverted = 0 AS s2,
    cancelled = 1 OR (dep_delay IS NOT NULL AND arr_delay IS NOT NULL) AS s3,
    month BETWEEN 1 AND 12 AS s4, trim(op_unique_carrier, ' ' || chr(9)) <> '' AND trim(origin, ' ' || chr(9)) <> '' AS s5 FROM flights_raw)"""
_register(
    "cleaning_funnel",
    _raw(quality.cleaning_funnel),
    _on_raw(
        f"""SELECT CAST(unnest([0, 1, 2, 3, 4, 5]) AS INT) AS step_no,
        unnest(['raw', 'mandatory_not_null', 'not_diverted', 'delays_present', 'valid_month',
          'keys_not_blank']) AS step, unnest([raw, a, b, c, d, e]) AS rows FROM ({_FUNNEL})"""
    ),
)
_register(
    "quality_summary",
    _raw(quality.quality_summary),
    _on_raw(
        f"""SELECT raw AS raw_rows, e AS kept_rows, raw - e AS removed_rows,
        {_rounded('CAST(raw - e AS DOUBLE) / nullif(raw, 0) * 100', 1)} AS removed_pct FROM ({_FUNNEL})"""
    ),
)
for _name, _key in (
    ("rows_by_month", "month"), ("rows_by_carrier", "op_unique_carrier"), ("rows_by_origin", "origin"),
):
    _register(
        _name,
        _clean(lambda df, key=_key: quality.rows_by(df, key)),
        _on_clean(f"SELECT {_key}, count(*) AS flights FROM flights GROUP BY {_key}"),
    )
for _name, _key, _top in (
    ("top_carriers", "op_unique_carrier", quality.top_carriers), ("top_origins", "origin", quality.top_origins),
):
    _register(
        _name,
        _clean(_top),
        _on_clean(
            f"""SELECT {_key}, count(*) AS flights FROM flights GROUP BY {_key}
            ORDER BY flights DESC, {_key} LIMIT 10"""
        ),
    )
_register("row_count", _clean(subsets.row_count), _on_clean("SELECT count(*) AS rows FROM flights"))

# --- Subsets --------------------------------------------------------------------------

_LADDER = {"1k": 1_000, "5k": 5_000, "20k": 20_000, "50k": 50_000, "500k": 500_000, "1M": 1_000_000}
_DRAW = "md5(concat_ws('|', '42', {}))".format(
    ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in FLIGHTS.names)
)
_RUNGS = ", ".join(f"('{name}', {n})" for name, n in _LADDER.items())


def _clean_table(spark, sf_dir, *more) -> DataFrame:
    """The clean flights, and more columns, as a table on disk: subsets scan it repeatedly."""
    path = scratch_path(spark, "flights")
    writing.write_table(binding.flights(spark, sf_dir).select("*", *more), path)
    return spark.read.parquet(path)


def _drawn_table(spark, sf_dir) -> tuple[DataFrame, subsets.Draw]:
    """The clean flights with a stored draw that the SQL can compute as well."""
    draw = subsets.portable_draw(FLIGHTS.names, 42)
    return _clean_table(spark, sf_dir, draw.column.alias(subsets.DRAW)), subsets.stored(draw)


def _exact_subset(spark, sf_dir):
    table, draw = _drawn_table(spark, sf_dir)
    return subsets.exact_subset(table, 5_000, draw=draw)


def _bernoulli_subset(spark, sf_dir):
    table, draw = _drawn_table(spark, sf_dir)
    return subsets.bernoulli_subset(table, 5_000, draw=draw)


def _subset_ladder(spark, sf_dir):
    table, draw = _drawn_table(spark, sf_dir)
    return _rung_totals(subsets.exact_ladder(table, _LADDER, draw=draw))


def _sampled_ladder(spark, sf_dir):
    table, draw = _drawn_table(spark, sf_dir)
    return _rung_totals(subsets.size_ladder(table, _LADDER, draw=draw))


def _one_pass(spark, sf_dir, exact: bool) -> DataFrame:
    """The same totals from one write of the dealt table, read back folder by folder."""
    table, draw = _drawn_table(spark, sf_dir)
    path = scratch_path(spark, "ladder")
    written = prepare.write_rungs(*subsets.dealt(table, _LADDER, draw=draw, exact=exact), path)
    return _rung_totals({name: reading.read_rung(spark, path, name, FLIGHTS) for name in written})


def _one_pass_ladder(spark, sf_dir):
    return _one_pass(spark, sf_dir, exact=False)


def _one_pass_exact_ladder(spark, sf_dir):
    return _one_pass(spark, sf_dir, exact=True)


def _seeded_shuffle(spark, sf_dir):
    table, draw = _drawn_table(spark, sf_dir)
    return subsets.permuted(table, draw=draw)


def _rung_totals(rungs: dict[str, DataFrame]) -> DataFrame:
    totals = [
        df.agg(
            F.lit(name).alias("size"),
            F.count("*").alias("rows"),
            F.sum("arr_delay").alias("arr_delay_sum"),
            F.sum("cancelled").alias("cancelled_sum"),
        )
        for name, df in rungs.items()
    ]
    union = totals[0]
    for total in totals[1:]:
        union = union.unionByName(total)
    return union


_register(
    "exact_subset",
    _exact_subset,
    _on_clean(f"SELECT * FROM flights ORDER BY {_DRAW} LIMIT 5000"),
)
# the second and later copies of a record draw by its draw and their number
_NUMBERED = f"""SELECT *, row_number() OVER (PARTITION BY {', '.join(FLIGHTS.names)}) AS copy,
          CAST('0x' || substr({_DRAW}, 1, 15) AS BIGINT) AS own FROM flights"""
_COPY_DRAW = "CASE WHEN copy = 1 THEN own ELSE CAST('0x' || substr(md5(own || '|' || copy), 1, 15) AS BIGINT) END"
_TOLD = f", told AS (SELECT * EXCLUDE (copy, own), {_COPY_DRAW} AS draw FROM ({_NUMBERED}))"
_RUNGS_CTE = f"""rungs AS (SELECT size, n, total FROM (VALUES {_RUNGS}, ('full', 9000000000000000)) AS v(size, n),
          (SELECT count(*) AS total FROM flights))"""
_SAMPLED = f"{_TOLD}, placed AS (SELECT *, row_number() OVER (ORDER BY draw) AS place FROM told), {_RUNGS_CTE}"
_PLACED = f", placed AS (SELECT *, row_number() OVER (ORDER BY {_DRAW}) AS place FROM flights), {_RUNGS_CTE}"
_RUNG_SQL = """SELECT size, count(*) AS rows, sum(arr_delay) AS arr_delay_sum,
        CAST(sum(cancelled) AS BIGINT) AS cancelled_sum
        FROM rungs JOIN placed ON place <= n WHERE {} GROUP BY size"""
# of a draw of 60 bits, so that a share of n / total passes
_BY_CHANCE = "draw < CAST(floor(CAST({n} AS DOUBLE) / {total} * 1152921504606846976::DOUBLE) AS BIGINT)"
_register(
    "bernoulli_subset",
    _bernoulli_subset,
    _on_clean(
        f"""SELECT {', '.join(FLIGHTS.names)} FROM placed, (SELECT count(*) AS total FROM flights)
        WHERE place <= 5000 AND CASE WHEN total > 5000 THEN {_BY_CHANCE.format(n=5000, total='total')} ELSE true END""",
        _SAMPLED,
    ),
)
_register("subset_ladder", _subset_ladder, _on_clean(_RUNG_SQL.format("n <= total OR size = 'full'"), _PLACED))
_register(
    "sampled_ladder",
    _sampled_ladder,
    _on_clean(
        _RUNG_SQL.format(
            f"size = 'full' OR n = total OR CASE WHEN n < total THEN {_BY_CHANCE.format(n='n', total='total')} END"
        ),
        _SAMPLED,
    ),
)
_register("one_pass_ladder", _one_pass_ladder, ORACLE["sampled_ladder"])
_register("one_pass_exact_ladder", _one_pass_exact_ladder, ORACLE["subset_ladder"])
_register(
    "seeded_shuffle",
    _seeded_shuffle,
    _on_clean(f"SELECT {', '.join(FLIGHTS.names)}, row_number() OVER (ORDER BY draw) - 1 AS position FROM told", _TOLD),
)
