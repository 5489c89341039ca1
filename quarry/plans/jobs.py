"""The three migration jobs, written as data: a table spec and ordered steps.

* file job: CSV -> rename -> one row per key -> drop rows with NULLs;
* document job: documents -> lift ``_id.oid`` -> required fields -> numbers from
  text with thousands commas -> one row per id, then per country -> (hold) ->
  NULLs filled with region means -> table columns;
* delimited job: payload lines -> required fields -> numbers from money text ->
  one row per code, then per name -> (hold) -> NULLs filled with region means ->
  table columns -> drop rows with NULLs.

Numbers are parsed before duplicates are dropped, so that a row whose number
is blank or no number counts as one with a gap and loses to a complete one.

:func:`run_job` checks the mode, the target and that the source is not read from
it before any Spark work, and then writes with the overwrite or update sink. The
sample queries at the end feed the unchanged job specs with source data derived
from the test tables, in the formats the jobs read (CSV with a header, JSON
documents, payloads of comma lines).
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.functions.numbers import money_to_double, parse_bigint, thousands_to_bigint
from quarry.operators.clean import drop_any_null, keep_columns, lift_field, rename, require
from quarry.operators.dedupe import keep_first_each
from quarry.operators.impute import impute_group_mean
from quarry.operators.staging import Staged, stage
from quarry.session import staging_path
from quarry.sinks.files import EmptyResultError
from quarry.sinks.tables import table_location
from quarry.sinks.targets import PathTarget, TableTarget
from quarry.sources.delimited import read_payloads
from quarry.sources.files import read_csv, read_documents
from quarry.specs import InsertMode, JobResult, TableSpec

# --- steps ---------------------------------------------------------------------


@dataclass(frozen=True)
class Rename:
    mapping: dict

    def apply(self, df):
        return rename(df, self.mapping)


@dataclass(frozen=True)
class LiftField:
    struct_col: str
    field_name: str
    alias: str

    def apply(self, df):
        return lift_field(df, self.struct_col, self.field_name, self.alias)


@dataclass(frozen=True)
class Require:
    columns: tuple
    trim: bool = False

    def apply(self, df):
        return require(df, self.columns, self.trim)


@dataclass(frozen=True)
class KeepFirst:
    """One row per key, for each key in turn (see :func:`keep_first`)."""

    keys: tuple
    order_by: tuple = ()

    def apply(self, df):
        return keep_first_each(df, [[k] if isinstance(k, str) else list(k) for k in self.keys],
                               self.order_by)


PARSERS = {
    "thousands_bigint": thousands_to_bigint,
    "bigint": parse_bigint,
    "money_double": money_to_double,
}


@dataclass(frozen=True)
class ParseNumbers:
    """``{column: parser}``; parsers are the keys of :data:`PARSERS`."""

    columns: dict

    def apply(self, df):
        return df.withColumns({c: PARSERS[p](c) for c, p in self.columns.items()})


@dataclass(frozen=True)
class ImputeMean:
    group: str
    columns: dict
    integer: tuple = ()
    scale: dict | None = None

    def apply(self, df, held=None):
        return impute_group_mean(df, self.group, self.columns, self.integer, scale=self.scale, held=held)


@dataclass(frozen=True)
class DropNulls:
    subset: tuple | None = None

    def apply(self, df):
        return drop_any_null(df, self.subset)


@dataclass(frozen=True)
class Select:
    columns: tuple

    def apply(self, df):
        return keep_columns(df, self.columns)


@dataclass(frozen=True)
class Hold:
    """Write the rows computed so far to the shared folder for the steps that read them twice.

    Imputation reads its input twice (group means, then the join back). After
    shuffling steps (dedupe) that would repeat the scan and the shuffles. A lost
    executor loses none of it. ``run_job`` deletes the rows after the write.
    """

    def apply(self, df, held=None):
        staged = stage(df, "job-rows")
        if held is not None:
            held.append(staged)
        return staged.df


@dataclass(frozen=True)
class JobSpec:
    name: str
    table: TableSpec
    steps: tuple = field(default_factory=tuple)

    def plan(self, source: DataFrame, held: list | None = None) -> DataFrame:
        """The job's result plan; staged frames that it reads are appended to ``held``."""
        df = source
        for step in self.steps:
            df = step.apply(df, held) if isinstance(step, (Hold, ImputeMean)) else step.apply(df)
        return keep_columns(df, self.table.columns)


# --- the three tables and jobs (fixed values: names of the original tables) -----

SPEED = TableSpec("internet_speed", ("country",), ("country", "avg_mbit_per_s_ookla"))
USERS = TableSpec("internet_users", ("id",),
                  ("id", "country", "internet_users", "population", "region", "sub_region"))
PRICES = TableSpec("internet_prices", ("country_code",),
                   ("country_code", "name", "continental_region", "no_internal_plans",
                    "avg_price_1gb_usd", "cheapest_1gb_30days_usd", "most_expensive_1gb_usd",
                    "avg_1gb_start2021_usd", "avg_1gb_start2020_usd"))

# Header texts of the speed CSV and the ordered header map of the
# price payload. Only the map's values are used, by position: the header line of a
# payload is its first element whatever its text, and is skipped as such.
SPEED_CSV_SCHEMA = "`Country` string, `Avg(Mbit/s)Ookla` double"
SPEED_RENAMES = {"Country": "country", "Avg(Mbit/s)Ookla": "avg_mbit_per_s_ookla"}
PRICE_HEADER_MAP = {
    "Country code": "country_code",
    "Name": "name",
    "Continental region": "continental_region",
    "NO. OF Internet Plans ": "no_internal_plans",
    "Average price of 1GB (USD)": "avg_price_1gb_usd",
    "Cheapest 1GB for 30 days (USD)": "cheapest_1gb_30days_usd",
    "Most expensive 1GB (USD)": "most_expensive_1gb_usd",
    "Average price of 1GB (USD at start of 2021)": "avg_1gb_start2021_usd",
    "Average price of 1GB (USD – at start of 2020)": "avg_1gb_start2020_usd",
}
PRICE_NAMES = list(PRICE_HEADER_MAP.values())
PRICE_MONEY = PRICE_NAMES[4:]

FILE_JOB = JobSpec("file", SPEED, (
    Rename(SPEED_RENAMES),
    KeepFirst(("country",)),
    DropNulls(),
))

DOCUMENT_JOB = JobSpec("documents", USERS, (
    LiftField("_id", "oid", "id"),
    Require(("id", "region", "sub_region", "country")),
    ParseNumbers({"internet_users": "thousands_bigint", "population": "thousands_bigint"}),
    KeepFirst(("id", "country")),
    Hold(),
    ImputeMean("region", {"internet_users": 0, "population": 0},
               integer=("internet_users", "population")),
))

DELIMITED_JOB = JobSpec("delimited", PRICES, (
    Require(("name", "continental_region", "country_code")),
    ParseNumbers({"no_internal_plans": "bigint", **{c: "money_double" for c in PRICE_MONEY}}),
    KeepFirst(("country_code", "name")),
    Hold(),
    ImputeMean("continental_region", {c: 2 for c in ["no_internal_plans", *PRICE_MONEY]},
               scale={c: 2 for c in PRICE_MONEY}),
    Select(tuple(PRICES.columns)),
    DropNulls(),
))


def observed_rows(seen: Observation, seconds: float = 10.0) -> int | None:
    """What the first pass over an observed frame counted. None if Spark did not report it: a plan that
    is known to be empty before it runs has no metrics, and waiting for them would not end."""
    end = time.monotonic() + seconds
    while not seen._jo.future().isCompleted():
        if time.monotonic() > end:
            return None
        time.sleep(0.05)
    return seen.get.get("rows")


def run_job(spark: SparkSession, spec: JobSpec, source: DataFrame, mode, target,
            out_path: str | None = None, allow_empty: bool = False,
            keep_missing: bool = True, rejects: DataFrame | None = None) -> JobResult:
    """Plan ``spec`` over ``source`` and write it to ``target``.

    ``target`` is a Parquet path or one of :mod:`quarry.sinks.targets`. ``overwrite``
    replaces it. ``update`` compares with it and writes the changed table (a path target
    to ``out_path``; its readers are repointed by the caller), or writes nothing if no row
    changed. A source or a result without rows is refused, and the target stays as it
    is, unless ``allow_empty``. ``rejects`` (lines the parser refused) are counted.

    ``rows_read`` counts the source's rows in the job's own first pass over them; rows that a
    lost executor makes Spark compute again count again.
    """
    mode = InsertMode.parse(mode)
    if isinstance(target, str):
        target = PathTarget(target, out_path)
    target.check(mode, source)
    if not allow_empty and source.isEmpty():
        raise ValueError(f"job {spec.name}: the source has no rows")
    held: list[Staged] = []
    seen = Observation(f"job-{spec.name}-{uuid.uuid4().hex[:8]}")
    try:
        df = spec.plan(source.observe(seen, F.count(F.lit(1)).alias("rows")), held)
        if mode is InsertMode.OVERWRITE:
            result = target.overwrite(df, allow_empty)
        else:
            rows = stage(df, "job-result")  # read by the key check, the change set and the merge
            held.append(rows)
            if not rows.rows() and not allow_empty:
                raise EmptyResultError(f"job {spec.name}: the result has no rows; the target stays as it is")
            result = target.update(rows.df, spec.table, keep_missing)
        result.rows_read = observed_rows(seen)
        if rejects is not None:
            result.rows_rejected = rejects.count()
        return result
    finally:
        for h in held:
            h.drop()


# --- sample queries: the jobs on source data derived from the test tables --------

def _t(spark, d, name):
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _every(c, n):
    return (F.col(c) % n) == 0


def _null(t="string"):
    return F.lit(None).cast(t)


def speed_csv(spark, d) -> str:
    """Part rows as the speed CSV: name as country, price as speed (some blank/NULL)."""
    p = _t(spark, d, "part")
    rows = p.select(
        F.when(_every("p_partkey", 17), _null()).otherwise(F.col("p_name")).alias("Country"),
        F.when(_every("p_partkey", 13), _null("double")).otherwise(F.col("p_retailprice"))
         .alias("Avg(Mbit/s)Ookla"))
    path = staging_path(spark, "speed-csv")
    rows.write.option("header", True).csv(path)
    return path


def _thousands_text(c):
    cents = F.round(F.col(c) * 100).cast("bigint")
    return F.concat(F.format_number(F.floor(cents / 100).cast("bigint"), 0), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"))


def user_documents(spark, d) -> str:
    """Orders as user documents: customer as country, priority as region."""
    o = _t(spark, d, "orders")
    docs = o.select(
        F.struct(F.col("o_orderkey").cast("string").alias("oid")).alias("_id"),
        F.when(_every("o_orderkey", 23), F.lit("")).otherwise(F.col("o_custkey").cast("string"))
         .alias("country"),
        F.when(_every("o_orderkey", 7), F.lit("NA")).otherwise(_thousands_text("o_totalprice"))
         .alias("internet_users"),
        F.when(_every("o_orderkey", 11), _null())
         .otherwise(F.format_number(F.col("o_orderkey") * 37, 0)).alias("population"),
        F.col("o_orderpriority").alias("region"),
        F.when(_every("o_orderkey", 29), F.lit("")).otherwise(F.col("o_orderstatus"))
         .alias("sub_region"))
    path = staging_path(spark, "user-docs")
    docs.write.json(path)
    return path


USER_DOC_SCHEMA = ("_id struct<oid:string>, country string, internet_users string, "
                   "population string, region string, sub_region string")


def _money(cents):
    return F.concat(F.lit("$"), F.floor(cents / 100).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"))


def price_payloads(spark, d) -> DataFrame:
    """Parts as price payloads: JSON arrays of a header and some hundred comma lines (9
    fields, some broken), each line with its line break."""
    p = _t(spark, d, "part")
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    fields = [
        F.concat_ws("-", "p_brand", F.col("p_size").cast("string")),
        F.when(_every("p_partkey", 9), F.concat(F.col("p_name"), F.lit(",x")))
         .otherwise(F.col("p_name")),
        F.when(_every("p_partkey", 31), F.lit("")).otherwise(F.col("p_type")),
        F.when(_every("p_partkey", 10), F.lit("")).otherwise(F.col("p_size").cast("string")),
        F.when(_every("p_partkey", 6), F.lit("$")).otherwise(_money(cents)),
        _money(cents - 100),
        _money(cents * 2),
        F.when(_every("p_partkey", 4), F.lit("")).otherwise(_money(cents + 50)),
        F.concat(_money(cents + 25), F.lit("\n")),
    ]
    body = p.select(F.floor(F.col("p_partkey") / 500).alias("payload"), F.concat_ws(",", *fields).alias("line"))
    header = F.array(F.lit(",".join(PRICE_HEADER_MAP) + "\n"))
    return body.groupBy("payload").agg(F.to_json(F.concat(header, F.collect_list("line"))).alias("value")).select("value")


def job_file_migration(spark, d):
    src = read_csv(spark, speed_csv(spark, d), schema=SPEED_CSV_SCHEMA, extra=True)
    target = staging_path(spark, "internet_speed")
    run_job(spark, FILE_JOB, src, "overwrite", target)
    return spark.read.parquet(target)


def speed_csv_later(spark, d) -> str:
    """A later delivery: columns in another order, one more column (its gaps drop rows),
    some countries renamed and some speeds changed."""
    p = _t(spark, d, "part")
    rows = p.select(
        F.when(_every("p_partkey", 19), _null("bigint")).otherwise(F.col("p_partkey")).alias("Rank"),
        F.when(_every("p_partkey", 13), _null("double")).when(_every("p_partkey", 7), F.col("p_retailprice") + 1)
         .otherwise(F.col("p_retailprice")).alias("Avg(Mbit/s)Ookla"),
        F.when(_every("p_partkey", 17), _null()).when(_every("p_partkey", 5), F.concat("p_name", F.lit(" new")))
         .otherwise(F.col("p_name")).alias("Country"))
    path = staging_path(spark, "speed-csv-later")
    rows.write.option("header", True).csv(path)
    return path


def job_table_migration(spark, d):
    """The file job into a catalog table: created by the overwrite, then updated."""
    name = f"quarry_speed_{uuid.uuid4().hex[:12]}"
    target = TableTarget(name, staging_path(spark, "internet_speed_table"), buckets=8, key=SPEED.key)
    for mode, path in (("overwrite", speed_csv(spark, d)), ("update", speed_csv_later(spark, d))):
        run_job(spark, FILE_JOB, read_csv(spark, path, schema=SPEED_CSV_SCHEMA, extra=True), mode, target)
    location = table_location(spark, name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return spark.read.parquet(location)


def job_document_migration(spark, d):
    src = read_documents(spark, user_documents(spark, d), schema=USER_DOC_SCHEMA)
    target = staging_path(spark, "internet_users")
    run_job(spark, DOCUMENT_JOB, src, "overwrite", target)
    return spark.read.parquet(target)


def job_delimited_migration(spark, d):
    path = staging_path(spark, "price-payloads")
    price_payloads(spark, d).write.text(path)
    src, rejects = read_payloads(spark, path, PRICE_NAMES, with_rejects=True)
    target = staging_path(spark, "internet_prices")
    run_job(spark, DELIMITED_JOB, src, "overwrite", target, rejects=rejects)
    return spark.read.parquet(target)


JOB_QUERIES = {
    "job_file_migration": job_file_migration,
    "job_table_migration": job_table_migration,
    "job_document_migration": job_document_migration,
    "job_delimited_migration": job_delimited_migration,
}


# --- oracle SQL for the job queries --------------------------------------------

def _sql_money(cents: str) -> str:
    return (f"('$' || CAST(({cents}) // 100 AS VARCHAR) || '.' || "
            f"lpad(CAST(({cents}) % 100 AS VARCHAR), 2, '0'))")


def _sql_parse_double(expr: str, strip: str = "") -> str:
    from quarry.plans.oracle import _parse_double
    return _parse_double(expr, strip)


def _sql_parse_bigint(expr: str, strip: str = "") -> str:
    from quarry.plans.oracle import _parse_bigint
    return _parse_bigint(expr, strip)


def _sql_mean(col: str, digits: int, places: int) -> str:
    from quarry.plans.oracle import exact_mean
    return exact_mean(col, digits, places)


def _sql_first(src: str, key: str, order: list[str], cols: list[str]) -> str:
    o = ", ".join(f"{c} NULLS LAST" for c in order)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {o}) AS rn FROM {src}) WHERE rn = 1")


_USERS_COLS = ["country", "internet_users", "population", "region", "sub_region", "id"]
_PRICE_CENTS = "CAST(round(p_retailprice * 100) AS BIGINT)"

JOB_ORACLE = {
    "job_file_migration": f"""
WITH src AS (
  SELECT CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_name END AS country,
         CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_retailprice END AS avg_mbit_per_s_ookla
  FROM part),
k AS ({_sql_first('src', 'country', ['avg_mbit_per_s_ookla'], ['country', 'avg_mbit_per_s_ookla'])})
SELECT country, avg_mbit_per_s_ookla FROM k
WHERE country IS NOT NULL AND avg_mbit_per_s_ookla IS NOT NULL""",

    "job_table_migration": f"""
WITH src AS (
  SELECT CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_name END AS country,
         CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_retailprice END AS avg_mbit_per_s_ookla
  FROM part),
later AS (
  SELECT CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN p_name || ' new' ELSE p_name END AS country,
         CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS avg_mbit_per_s_ookla,
         CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS rank
  FROM part),
k AS ({_sql_first('src', 'country', ['avg_mbit_per_s_ookla'], ['country', 'avg_mbit_per_s_ookla'])}),
l AS ({_sql_first('later', 'country', ['avg_mbit_per_s_ookla', 'rank'], ['country', 'avg_mbit_per_s_ookla', 'rank'])}),
newer AS (SELECT country, avg_mbit_per_s_ookla FROM l
          WHERE country IS NOT NULL AND avg_mbit_per_s_ookla IS NOT NULL AND rank IS NOT NULL)
SELECT * FROM newer
UNION ALL
SELECT country, avg_mbit_per_s_ookla FROM k WHERE country IS NOT NULL AND avg_mbit_per_s_ookla IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM newer WHERE newer.country = k.country)""",

    "job_document_migration": f"""
WITH docs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
         CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS country,
         CASE WHEN o_orderkey % 7 = 0 THEN 'NA'
              ELSE format('{{:,}}', CAST(round(o_totalprice * 100) AS BIGINT) // 100) || '.' ||
                   lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0')
         END AS internet_users,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL
              ELSE format('{{:,}}', o_orderkey * 37) END AS population,
         o_orderpriority AS region,
         CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE o_orderstatus END AS sub_region
  FROM orders),
req AS (SELECT * FROM docs WHERE id <> '' AND region <> '' AND sub_region <> ''
                             AND country <> ''),
parsed AS (
  SELECT id, country, {_sql_parse_bigint('internet_users', ',')} AS internet_users,
         {_sql_parse_bigint('population', ',')} AS population, region, sub_region FROM req),
k1 AS ({_sql_first('parsed', 'id', [c for c in _USERS_COLS if c != 'id'], _USERS_COLS)}),
num AS ({_sql_first('k1', 'country', [c for c in _USERS_COLS if c != 'country'], _USERS_COLS)}),
m AS (
  SELECT region, CAST({_sql_mean('internet_users', 0, 0)} AS BIGINT) AS mu,
         CAST({_sql_mean('population', 0, 0)} AS BIGINT) AS mp FROM num GROUP BY region)
SELECT n.id, n.country, coalesce(n.internet_users, m.mu) AS internet_users,
       coalesce(n.population, m.mp) AS population, n.region, n.sub_region
FROM num n LEFT JOIN m ON n.region = m.region""",

    "job_delimited_migration": f"""
WITH lines AS (
  SELECT concat_ws(',',
    p_brand || '-' || CAST(p_size AS VARCHAR),
    CASE WHEN p_partkey % 9 = 0 THEN p_name || ',x' ELSE p_name END,
    CASE WHEN p_partkey % 31 = 0 THEN '' ELSE p_type END,
    CASE WHEN p_partkey % 10 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END,
    CASE WHEN p_partkey % 6 = 0 THEN '$' ELSE {_sql_money(_PRICE_CENTS)} END,
    {_sql_money(_PRICE_CENTS + ' - 100')},
    {_sql_money(_PRICE_CENTS + ' * 2')},
    CASE WHEN p_partkey % 4 = 0 THEN '' ELSE {_sql_money(_PRICE_CENTS + ' + 50')} END,
    {_sql_money(_PRICE_CENTS + ' + 25')} || chr(10)) AS value
  FROM part),
parts AS (SELECT string_split(value, ',') AS p FROM lines),
rows AS (
  SELECT {', '.join(f'p[{i + 1}] AS {c}' for i, c in enumerate(PRICE_NAMES))}
  FROM parts WHERE len(p) = 9),
req AS (SELECT * FROM rows WHERE name <> '' AND continental_region <> '' AND country_code <> ''),
parsed AS (
  SELECT country_code, name, continental_region,
         {_sql_parse_bigint('no_internal_plans')} AS no_internal_plans,
         {', '.join(_sql_parse_double(c, '$' + chr(13) + chr(10)) + ' AS ' + c
                    for c in PRICE_MONEY)}
  FROM req),
k1 AS ({_sql_first('parsed', 'country_code', PRICE_NAMES[1:], PRICE_NAMES)}),
num AS ({_sql_first('k1', 'name', [c for c in PRICE_NAMES if c != 'name'], PRICE_NAMES)}),
m AS (
  SELECT continental_region,
         {_sql_mean('no_internal_plans', 2, 0)} AS m_no_internal_plans,
         {', '.join(f'{_sql_mean(c, 2, 2)} AS m_{c}' for c in PRICE_MONEY)}
  FROM num GROUP BY continental_region),
filled AS (
  SELECT n.country_code, n.name, n.continental_region,
         {', '.join(f'coalesce(n.{c}, m.m_{c}) AS {c}' for c in ['no_internal_plans', *PRICE_MONEY])}
  FROM num n LEFT JOIN m ON n.continental_region = m.continental_region)
SELECT * FROM filled WHERE {' AND '.join(f'{c} IS NOT NULL' for c in PRICE_NAMES)}""",
}
