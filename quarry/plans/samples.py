"""The library's operators run on the driver's test tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame that reads the
given tables (or data Spark derives from them), over whole tables. The test
tables hold no NULLs or blanks, so the hostile values the operators exist for
(blank fields, money text, thousands commas, broken lines, NULLs to impute,
changed rows) are derived from the rows by fixed rules written out below;
:mod:`quarry.plans.oracle` states the same rules in SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.numbers import money_to_double, parse_bigint, thousands_to_bigint
from quarry.operators.clean import drop_any_null, lift_field, rename, require
from quarry.operators.dedupe import keep_first, keep_first_each
from quarry.operators.delta import changed_rows
from quarry.operators.impute import group_means, impute_group_mean
from quarry.operators.staging import stage
from quarry.plans import reports
from quarry.session import staging_path
from quarry.sinks.files import write_overwrite, write_update
from quarry.sinks.landed import update_from_landed
from quarry.sinks.partitions import create_partitioned, read_partitioned, update_partitioned
from quarry.sinks.tables import create_table, table_location, update_table
from quarry.sources.delimited import read_lines, read_payloads
from quarry.sources.file_index import read_equal, refresh_index
from quarry.sources.files import read_csv, read_documents
from quarry.sources.headers import read_csv_folder
from quarry.sources.variants import read_mixed_documents

# Fixed values for the sample queries.
SUPPLIER_CSV = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
CUSTOMER_CSV = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double"
LOOKUP_CUSTOMER = 7
LOOKUP_NATION = "NATION_7"
PART_RENAMES = {"p_partkey": "part_key", "p_name": "name", "p_brand": "brand",
                "p_type": "type", "p_size": "size", "p_retailprice": "retail_price"}
ORDER_LINE_NAMES = ["order_key", "status", "priority"]
ORDER_KEY = ["o_orderkey"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _every(key: str, n: int) -> Column:
    return (F.col(key) % n) == 0


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def _decimal_text(c: str, thousands: bool) -> Column:
    """Exact text of a 2-decimal amount, e.g. ``1,234.56`` or ``1234.56``."""
    cents = _cents(c)
    whole = F.floor(cents / 100).cast("bigint")
    frac = F.lpad((cents % 100).cast("string"), 2, "0")
    head = F.format_number(whole, 0) if thousands else whole.cast("string")
    return F.concat(head, F.lit("."), frac)


# --- sources -----------------------------------------------------------------

def src_csv(spark, d):
    """Supplier rows landed as CSV with a header, read back with a fixed schema."""
    path = staging_path(spark, "supplier-csv")
    table(spark, d, "supplier").write.option("header", True).csv(path)
    return read_csv(spark, path, schema=SUPPLIER_CSV)


def src_csv_by_name(spark, d):
    """The same rows from a file with its columns in another order and one more between them."""
    path = staging_path(spark, "supplier-csv")
    s = table(spark, d, "supplier")
    s.select("s_acctbal", F.lit("x").alias("note"), "s_name", "s_suppkey", "s_nationkey").write.option("header", True).csv(path)
    return read_csv(spark, path, schema=SUPPLIER_CSV)


def src_csv_folder(spark, d):
    """Customers in one folder of files with three different headers, one of them without a column."""
    path, c = staging_path(spark, "customer-csv"), table(spark, d, "customer")
    headers = [["c_custkey", "c_name", "c_nationkey", "c_acctbal"], ["c_acctbal", "c_nationkey", "c_custkey", "c_name"],
               ["c_mktsegment", "c_name", "c_custkey", "c_acctbal"]]
    for n, names in enumerate(headers):
        c.where(F.col("c_custkey") % 3 == n).select(*names).write.mode("append").option("header", True).csv(path)
    return read_csv_folder(spark, path, CUSTOMER_CSV, optional=["c_nationkey"])


def src_nested_documents(spark, d):
    """Events exported as JSON documents with a nested ``_id``; the id is lifted."""
    docs = table(spark, d, "events").select(
        F.struct(F.col("event_id").cast("string").alias("oid")).alias("_id"),
        "ts", "user_id", "event_type", "value",
        F.from_json("props", "k int").alias("props"))
    path = staging_path(spark, "event-docs")
    micros = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}  # the default keeps milliseconds
    docs.write.options(**micros).json(path)
    schema = ("_id struct<oid:string>, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props struct<k:int>")
    back = lift_field(read_documents(spark, path, schema=schema, **micros), "_id", "oid", "id")
    return back.select("id", "ts", "user_id", "event_type", "value", F.col("props.k").alias("k"))


def src_mixed_documents(spark, d):
    """Events exported as documents whose ``_id`` is a struct, a text or a number, and whose ``user_id`` is at times
    text; every eleventh breaks off. Rows, and the broken lines beside them."""
    key, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    name = (F.when(_every("event_id", 3), F.concat(F.lit('{"oid":"'), key, F.lit('"}')))
             .when(_every("event_id", 2), F.concat(F.lit('"'), key, F.lit('"'))).otherwise(key))
    line = F.concat(F.lit('{"_id":'), name,
                    F.lit(',"user_id":'), F.coalesce(F.when(_every("event_id", 5), F.concat(F.lit('"'), user, F.lit('"'))).otherwise(user), F.lit("null")),
                    F.lit(',"event_type":'), F.coalesce(F.concat(F.lit('"'), "event_type", F.lit('"')), F.lit("null")),
                    F.when(_every("event_id", 11), F.lit("")).otherwise(F.lit("}")))
    path = land_lines(table(spark, d, "events").select(line.alias("value")), "mixed-docs")
    rows, rejects = read_mixed_documents(spark, path, {
        "id": (["$._id.oid", "$._id"], "string"), "user_id": (["$.user_id"], "bigint"), "event_type": (["$.event_type"], "string")},
        with_rejects=True)
    return rows.unionByName(rejects, allowMissingColumns=True)


def _order_lines(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    key = F.col("o_orderkey").cast("string")
    line = (F.when(_every("o_orderkey", 5),
                   F.concat_ws(",", key, "o_orderstatus", "o_orderpriority", F.lit("")))
             .when(_every("o_orderkey", 7),
                   F.concat_ws(",", key, "o_orderstatus",
                               F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(',x"'))))
             .otherwise(F.concat_ws(",", key, "o_orderstatus", "o_orderpriority")))
    header = spark.createDataFrame([(",".join(ORDER_LINE_NAMES),)], "value string")
    return header.unionByName(o.select(line.alias("value")))


def land_lines(lines: DataFrame, name: str) -> str:
    """Write a DataFrame of text lines as landed payload files; return the folder."""
    path = staging_path(lines.sparkSession, name)
    lines.write.text(path)
    return path


def src_delimited_lines(spark, d):
    """Order lines landed as a comma payload; lines without exactly 3 fields are rejected."""
    path = land_lines(_order_lines(spark, d), "order-lines")
    return read_lines(spark, path, ORDER_LINE_NAMES, header=",".join(ORDER_LINE_NAMES))


def src_delimited_rejects(spark, d):
    """The rejected lines of the same payload, so dropped input stays visible."""
    path = land_lines(_order_lines(spark, d), "order-lines")
    _, rejects = read_lines(spark, path, ORDER_LINE_NAMES, header=",".join(ORDER_LINE_NAMES),
                            with_rejects=True)
    return rejects


def src_payload_rejects(spark, d):
    """Payloads that broke off, beside the rows of those that did not: one payload per customer, cut short every eleventh."""
    cut = F.when(_every("c_custkey", 11), F.lit("")).otherwise(F.lit("]"))
    line = F.concat(F.col("c_name"), F.lit(","), F.col("c_custkey").cast("string"))
    path = land_lines(table(spark, d, "customer").select(
        F.concat(F.lit('["name,id","'), line, F.lit('"'), cut).alias("value")), "customer-payloads")
    rows, rejects = read_payloads(spark, path, ["name", "id"], with_rejects=True)
    return rows.select(F.concat_ws(",", "name", "id").alias("line"), F.lit(False).alias("rejected")).unionByName(
        rejects.select("line", F.lit(True).alias("rejected")))


# --- projections and filters -------------------------------------------------

def proj_rename(spark, d):
    return rename(table(spark, d, "part"), PART_RENAMES)


def _blanked_customers(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    return c.withColumns({
        "c_mktsegment": F.when(_every("c_custkey", 11), F.lit(None).cast("string"))
                         .when(_every("c_custkey", 9), F.lit(""))
                         .otherwise(F.col("c_mktsegment")),
        "c_name": F.when(_every("c_custkey", 13), F.lit(" ")).otherwise(F.col("c_name")),
    })


def filter_required_not_blank(spark, d):
    return require(_blanked_customers(spark, d), ["c_name", "c_mktsegment"])


def _documents_labelled(spark, d) -> DataFrame:
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")


def filter_drop_any_null(spark, d):
    return drop_any_null(_documents_labelled(spark, d))


# --- number text ---------------------------------------------------------------

def clean_numbers_thousands(spark, d):
    o = table(spark, d, "orders")
    text = (F.when(_every("o_orderkey", 7), F.lit("NA"))
             .when(_every("o_orderkey", 11), F.lit(""))
             .otherwise(_decimal_text("o_totalprice", thousands=True)))
    return o.select("o_orderkey", thousands_to_bigint(text).alias("total_units"))


def clean_numbers_money(spark, d):
    o = table(spark, d, "orders")
    amount = _decimal_text("o_totalprice", thousands=False)
    text = (F.when(_every("o_orderkey", 7), F.lit("$"))
             .when(_every("o_orderkey", 11), F.lit("$NaN\n"))
             .when(_every("o_orderkey", 13), F.concat(F.lit("$ "), amount, F.lit("\n")))
             .otherwise(F.concat(F.lit("$"), amount, F.lit("\n"))))
    return o.select("o_orderkey", money_to_double(text).alias("price"))


def clean_numbers_int_text(spark, d):
    p = table(spark, d, "part")
    size = F.col("p_size").cast("string")
    text = (F.when(_every("p_partkey", 10), F.lit(""))
             .when((F.col("p_partkey") % 10) == 1, F.concat(size, F.lit(".7")))
             .when((F.col("p_partkey") % 10) == 2, F.concat(size, F.lit("000000000")))
             .otherwise(size))
    return p.select("p_partkey", parse_bigint(text).alias("size"))


# --- duplicates ----------------------------------------------------------------

def dedupe_one_key(spark, d):
    """One document per distinct text: the lowest doc_id."""
    return keep_first(table(spark, d, "documents"), "text", order_by="doc_id", unique_order=True)


def dedupe_two_keys(spark, d):
    return keep_first_each(table(spark, d, "lineitem"),
                           [["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]])


def dedupe_hot_keys(spark, d):
    """One line item per (return flag, line status): each key holds about a third of all rows."""
    return keep_first(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"])


# --- group means and imputation ----------------------------------------------

def agg_group_mean_int(spark, d):
    li = table(spark, d, "lineitem")
    return group_means(li, "l_returnflag", {"l_quantity": 0, "l_extendedprice": 0},
                       integer=["l_quantity", "l_extendedprice"])


def agg_group_mean_2dp(spark, d):
    li = table(spark, d, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return group_means(li, "l_returnflag", {c: 2 for c in cols}, scale={c: 2 for c in cols})


def _orders_with_gaps(spark, d) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return o.withColumns({
        "o_totalprice": F.when(_every("o_orderkey", 7), F.lit(None).cast("double"))
                         .otherwise(F.col("o_totalprice")),
        "o_orderpriority": F.when(_every("o_orderkey", 19), F.lit(None).cast("string"))
                            .otherwise(F.col("o_orderpriority")),
    })


def impute_group_mean_q(spark, d):
    return impute_group_mean(_orders_with_gaps(spark, d), "o_orderpriority", {"o_totalprice": 2},
                             scale={"o_totalprice": 2})


def impute_group_mean_joined(spark, d):
    docs = _documents_labelled(spark, d).select("doc_id", "lang", "quality", "toxic")
    return impute_group_mean(docs, "lang", {"quality": 0, "toxic": 2}, integer=["quality"])


# --- change sets and sinks -----------------------------------------------------

def delta_source(spark, d) -> DataFrame:
    o = table(spark, d, "orders").select(*ORDER_COLUMNS)
    return o.withColumn("o_orderstatus", F.when(_every("o_orderkey", 17), F.lit(None).cast("string"))
                        .otherwise(F.col("o_orderstatus")))


def delta_target(spark, d) -> DataFrame:
    o = table(spark, d, "orders").select(*ORDER_COLUMNS)
    o = o.where((F.col("o_orderkey") % 10) != 3)
    return o.withColumns({
        "o_orderstatus": F.when(_every("o_orderkey", 11), F.lit("Z"))
                          .when(_every("o_orderkey", 13) | _every("o_orderkey", 34),
                                F.lit(None).cast("string"))
                          .otherwise(F.col("o_orderstatus")),
        "o_orderdate": F.when(_every("o_orderkey", 19), F.col("o_orderdate") - F.expr("INTERVAL 1 DAY"))
                        .otherwise(F.col("o_orderdate"))})


def delta_changed_rows(spark, d):
    return changed_rows(delta_source(spark, d), delta_target(spark, d), ORDER_KEY, ORDER_COLUMNS)


def delta_changed_rows_null_as_changed(spark, d):
    return changed_rows(delta_source(spark, d), delta_target(spark, d), ORDER_KEY,
                        ORDER_COLUMNS, rule="null_as_changed")


def agg_delta_count(spark, d):
    return delta_changed_rows(spark, d).agg(F.count(F.lit(1)).alias("changed_rows"))


def sink_overwrite_roundtrip(spark, d):
    """Region written, then overwritten at the same path, then read back."""
    path = staging_path(spark, "region-table")
    region = table(spark, d, "region")
    write_overwrite(region.withColumn("r_name", F.lower("r_name")), path)
    write_overwrite(region, path)
    return spark.read.parquet(path)


def _update(spark, d, source: DataFrame, keep_missing: bool = True):
    target = stage(delta_target(spark, d), "orders-target").df
    out = staging_path(spark, "orders-v2")
    res = write_update(source, target, ORDER_KEY, ORDER_COLUMNS, out, keep_missing=keep_missing)
    return res, target, out


def sink_update_upsert(spark, d):
    res, target, out = _update(spark, d, delta_source(spark, d))
    return spark.read.parquet(out) if res.wrote else target


def sink_update_replace(spark, d):
    res, target, out = _update(spark, d, delta_source(spark, d), keep_missing=False)
    return spark.read.parquet(out) if res.wrote else target


def sink_update_deletions(spark, d):
    """Source equal to the target but for rows it lacks: they go, though nothing else changed."""
    target = stage(delta_target(spark, d), "orders-target").df
    source = target.where((F.col("o_orderkey") % 10) != 4)
    out = staging_path(spark, "orders-v2")
    res = write_update(source, target, ORDER_KEY, ORDER_COLUMNS, out, keep_missing=False)
    return spark.read.parquet(out) if res.wrote else target


def sink_update_table(spark, d):
    """Catalog table bucketed by the key: created, updated, repointed to the new version."""
    name = f"quarry_orders_{uuid.uuid4().hex[:12]}"
    create_table(delta_target(spark, d), name, staging_path(spark, "orders-table"),
                 buckets=8, key=ORDER_KEY)
    update_table(delta_source(spark, d), name, ORDER_KEY, ORDER_COLUMNS)
    location = table_location(spark, name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return spark.read.parquet(location)


def sink_update_parts(spark, d):
    """A table in hash partitions of its key, updated with deletions: only touched parts are rewritten."""
    path = staging_path(spark, "orders-parts")
    create_partitioned(delta_target(spark, d), path, ORDER_KEY, 16)
    source = delta_source(spark, d).where((F.col("o_orderkey") % 10) != 4)
    update_partitioned(source, path, ORDER_KEY, ORDER_COLUMNS, 16, keep_missing=False)
    return read_partitioned(spark, path).select(*ORDER_COLUMNS)


def sink_update_carries_columns(spark, d):
    """An update that names one column of three: the others keep their values."""
    path = staging_path(spark, "orders-wide")
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    old = orders.withColumn("o_totalprice", F.when(_every("o_orderkey", 3), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    create_partitioned(old, path, "o_orderkey", 16)
    update_partitioned(orders.select("o_orderkey", "o_totalprice"), path, "o_orderkey", ["o_totalprice"])
    return read_partitioned(spark, path).select(*orders.columns)


def sink_version_history(spark, d):
    """Two versions of a partitioned table, made by an update: both are there, whole."""
    path = staging_path(spark, "orders-versions")
    create_partitioned(delta_target(spark, d), path, ORDER_KEY, 16)
    update_partitioned(delta_source(spark, d), path, ORDER_KEY, ORDER_COLUMNS)
    both = [read_partitioned(spark, path, n).select(F.lit(n).cast("bigint").alias("version"), *ORDER_COLUMNS) for n in (1, 2)]
    return both[0].unionByName(both[1])


def sink_update_snapshot(spark, d):
    """A snapshot of line items applied to the table of its first rows per key, and then once more: the second
    time the digests of all parts are equal and no row of the table is read."""
    path, lines = staging_path(spark, "lines-snapshot"), stage(_lines_once(spark, d), "lines-once").df
    old = lines.withColumn("l_tax", F.when(_every("l_orderkey", 3), F.col("l_tax") + 1).otherwise(F.col("l_tax")))
    create_partitioned(old, path, LINE_KEY, 32)
    runs = [update_partitioned(lines, path, LINE_KEY, lines.columns) for _ in range(2)]
    reports = [(n, r.rows_read, r.rows_written, len(r.details["compared"]) > 0, r.wrote) for n, r in enumerate(runs, 1)]
    rows = read_partitioned(spark, path).count()
    return (spark.createDataFrame(reports, "run bigint, rows_read bigint, rows_written bigint, compared boolean, wrote boolean")
            .withColumn("table_rows", F.lit(rows).cast("bigint")))


def sink_landed_payloads(spark, d):
    """Customers landed as payloads in two waves, the second with new balances for some of the first; the table takes
    each file once. Its rows, and how many rows the three runs read (the third finds no new file)."""
    folder, path = staging_path(spark, "customer-landing"), staging_path(spark, "customer-table")
    c = table(spark, d, "customer").select("c_custkey", "c_name", _cents("c_acctbal").alias("cents"))
    create_partitioned(c.limit(0), path, "c_custkey", 16)

    def land(rows: DataFrame) -> None:
        line = F.concat(F.lit('["id,name,cents","'), F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", F.col("cents").cast("string")), F.lit('"]'))
        rows.select(line.alias("value")).write.mode("append").text(folder)

    def rows_of(paths):
        return read_payloads(spark, paths, ["id", "name", "cents"]).select(
            parse_bigint("id").cast(c.schema["c_custkey"].dataType).alias("c_custkey"), F.col("name").alias("c_name"), parse_bigint("cents").alias("cents"))

    read = []
    for wave in (c.where(F.col("c_custkey") % 2 == 0).withColumn("cents", F.col("cents") + 1),
                 c.where((F.col("c_custkey") % 2 == 1) | _every("c_custkey", 3)), None):
        if wave is not None:
            land(wave)
        read.append(update_from_landed(spark, folder, path, rows_of, ["c_name", "cents"]).rows_read)
    runs = [F.lit(n).cast("bigint").alias(f"rows_{i}") for i, n in enumerate(read, 1)]
    return read_partitioned(spark, path).select("c_custkey", "c_name", "cents", *runs)


LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice"]


def _lines_once(spark, d) -> DataFrame:
    return keep_first(table(spark, d, "lineitem"), LINE_KEY)


def sink_overwrite_lines(spark, d):
    """All line items written over an older version of themselves."""
    path = staging_path(spark, "lines-table")
    lines = table(spark, d, "lineitem")
    write_overwrite(lines.withColumn("l_quantity", F.col("l_quantity") + 1), path)
    write_overwrite(lines, path)
    return spark.read.parquet(path)


def sink_update_lines(spark, d):
    """Line items updated by a key of six columns: some new, some changed."""
    lines = stage(_lines_once(spark, d), "lines").df
    target = lines.where((F.col("l_orderkey") % 10) != 3).withColumn(
        "l_returnflag", F.when(_every("l_orderkey", 7), F.lit(None).cast("string")).otherwise(F.col("l_returnflag")))
    target = stage(target, "lines-target").df
    out = staging_path(spark, "lines-v2")
    write_update(lines, target, LINE_KEY, lines.columns, out)
    return spark.read.parquet(out)


def sink_update_noop(spark, d):
    """Source equal to the target: nothing is written, zero rows reported."""
    target = stage(delta_target(spark, d), "orders-target").df
    out = staging_path(spark, "orders-v2")
    res = write_update(target, target, ORDER_KEY, ORDER_COLUMNS, out)
    return target.agg(F.count(F.lit(1)).alias("target_rows")).select(
        F.lit(res.rows_written).cast("bigint").alias("rows_written"),
        F.lit(res.wrote).alias("wrote"), "target_rows")


# --- reports -------------------------------------------------------------------

def _per_nation_mean(spark, d, fact: str, key: str, value: str, name_as: str, value_as: str):
    f = table(spark, d, fact)
    n = table(spark, d, "nation")
    j = f.join(n, f[key] == n["n_nationkey"], "inner")
    means = group_means(j, "n_name", {value: 2}, prefix="mean_", scale={value: 2})
    return means.select(F.col("n_name").alias(name_as), F.col("mean_" + value).alias(value_as))


def report_lookup(spark, d):
    speed = _per_nation_mean(spark, d, "supplier", "s_nationkey", "s_acctbal",
                             "country", "avg_speed")
    prices = _per_nation_mean(spark, d, "customer", "c_nationkey", "c_acctbal",
                              "name", "avg_price")
    return reports.lookup(prices, speed, "name", "country", LOOKUP_NATION,
                          {"country": "country", "mbit_per_s": "avg_speed",
                           "price_1gb_usd": "avg_price"})


def report_lookup_files(spark, d):
    """The orders of one customer from a table of 16 files: an index tells which of them can hold any. Beside
    each row, whether at most a quarter of the files was opened."""
    path, index = staging_path(spark, "orders-files"), staging_path(spark, "orders-index")
    orders = table(spark, d, "orders").select(*ORDER_COLUMNS)
    orders.repartition(16, "o_custkey").write.parquet(path)
    files = refresh_index(spark, path, "o_custkey", index)
    found = read_equal(spark, path, "o_custkey", index, LOOKUP_CUSTOMER)
    return found.withColumn("few_files", F.lit(4 * len(found.inputFiles()) <= files))


def _extreme(qt):
    def q(spark, d):
        return reports.extreme_row(table(spark, d, "customer"), "c_name", "c_acctbal", qt)
    return q


def _group_avg(qt):
    def q(spark, d):
        return reports.best_group(table(spark, d, "lineitem"), "l_returnflag",
                                  {"highest": "l_extendedprice", "lowest": "l_discount"}, qt)
    return q


def _group_avg_join(qt):
    def q(spark, d):
        return reports.best_group_joined(table(spark, d, "supplier"), table(spark, d, "nation"),
                                         ("s_nationkey", "n_nationkey"), "n_name", "s_acctbal", qt, scale=2)
    return q


def report_group_avg_join_top3(spark, d):
    """Top-k variant of the joined report: the three nations with the highest mean."""
    return reports.best_group_joined(table(spark, d, "supplier"), table(spark, d, "nation"),
                                     ("s_nationkey", "n_nationkey"), "n_name", "s_acctbal",
                                     "highest", scale=2, k=3)


def flagship(spark, d):
    """Sub-group with the highest mean over a join (the minimum end-to-end slice)."""
    return _group_avg_join("highest")(spark, d)


QUERIES = {
    "src_csv": src_csv,
    "src_csv_by_name": src_csv_by_name,
    "src_csv_folder": src_csv_folder,
    "src_nested_documents": src_nested_documents,
    "src_delimited_lines": src_delimited_lines,
    "src_delimited_rejects": src_delimited_rejects,
    "src_payload_rejects": src_payload_rejects,
    "src_mixed_documents": src_mixed_documents,
    "proj_rename": proj_rename,
    "filter_required_not_blank": filter_required_not_blank,
    "filter_drop_any_null": filter_drop_any_null,
    "clean_numbers_thousands": clean_numbers_thousands,
    "clean_numbers_money": clean_numbers_money,
    "clean_numbers_int_text": clean_numbers_int_text,
    "dedupe_one_key": dedupe_one_key,
    "dedupe_two_keys": dedupe_two_keys,
    "dedupe_hot_keys": dedupe_hot_keys,
    "agg_group_mean_int": agg_group_mean_int,
    "agg_group_mean_2dp": agg_group_mean_2dp,
    "impute_group_mean": impute_group_mean_q,
    "impute_group_mean_joined": impute_group_mean_joined,
    "delta_changed_rows": delta_changed_rows,
    "delta_changed_rows_null_as_changed": delta_changed_rows_null_as_changed,
    "agg_delta_count": agg_delta_count,
    "sink_overwrite_roundtrip": sink_overwrite_roundtrip,
    "sink_update_upsert": sink_update_upsert,
    "sink_update_replace": sink_update_replace,
    "sink_update_deletions": sink_update_deletions,
    "sink_update_table": sink_update_table,
    "sink_overwrite_lines": sink_overwrite_lines,
    "sink_update_lines": sink_update_lines,
    "sink_update_parts": sink_update_parts,
    "sink_update_carries_columns": sink_update_carries_columns,
    "sink_version_history": sink_version_history,
    "sink_update_snapshot": sink_update_snapshot,
    "sink_landed_payloads": sink_landed_payloads,
    "sink_update_noop": sink_update_noop,
    "report_lookup": report_lookup,
    "report_lookup_files": report_lookup_files,
    "report_extreme_high": _extreme("highest"),
    "report_extreme_low": _extreme("lowest"),
    "report_group_avg_high": _group_avg("highest"),
    "report_group_avg_low": _group_avg("lowest"),
    "report_group_avg_join_high": _group_avg_join("highest"),
    "report_group_avg_join_low": _group_avg_join("lowest"),
    "report_group_avg_join_top3": report_group_avg_join_top3,
}
