"""Registered queries: writes, the checks before them, and reading the result back."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.text import partition_path as path_of
from tablegate.functions.widening import WideningError, can_widen, set_exact, upgrade_to, widen
from tablegate.plans.jobs import map_only_write as map_only_job
from tablegate.plans.jobs import output_job
from tablegate.plans.read_queries import lineitem_positions
from tablegate.plans.registry import create_table, given, query
from tablegate.sinks.checks import OutputCheckError
from tablegate.sinks.tables import Output, write_outputs, write_table
from tablegate.sinks.tables import write_profiles as write_named
from tablegate.sources.partitions import list_partitions as partitions_of
from tablegate.sources.tables import read_table
from tablegate.spec import ReadSpec, WriteSpec, quote_table

SUPPLIER = "s_suppkey bigint, s_name string, s_acctbal double"
LINE_KEYS = "i1 bigint, i2 bigint, i3 bigint"


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_acctbal")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def write_unpartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = create_table(spark, "suppliers", SUPPLIER)
    write_table(_suppliers(spark, sf_dir), WriteSpec(table))
    return read_table(spark, ReadSpec(table=table))


@query("SELECT s_suppkey, s_name, 'a/b' AS ds FROM supplier")
def write_static_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = create_table(spark, "suppliers", "s_suppkey bigint, s_name string", ("ds",))
    rows = given(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    write_table(rows, WriteSpec(table, {"DS": "a/b"}))
    return read_table(spark, ReadSpec(table=table))


@query(
    """SELECT o_orderkey, o_orderpriority, '007' AS ds, 'x=1 100%' AS part FROM orders
       WHERE o_orderstatus <> 'F'"""
)
def write_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition values stay text and are found again by a filter on them."""
    table = create_table(
        spark, "orders_kept", "o_orderkey bigint, o_orderpriority string", ("ds", "part")
    )
    orders = given(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    finished = F.col("o_orderstatus") == "F"
    rows = {"100%": orders.where(finished), "x=1 100%": orders.where(~finished)}
    for part, chosen in rows.items():
        spec = WriteSpec(table, {"part": part, "ds": "007"})
        write_table(chosen.drop("o_orderstatus"), spec)
    return read_table(spark, ReadSpec(table=table, partition_filter="part = 'x=1 100%'"))


@query(
    """SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS ds
       FROM supplier WHERE s_nationkey % 2 = 0 OR s_suppkey % 2 = 0"""
)
def overwrite_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacing one partition leaves the others alone."""
    table = create_table(spark, "suppliers", "s_suppkey bigint", ("ds",))
    rows = given(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    even = F.col("s_nationkey") % 2 == 0
    write_table(rows.where(even).select("s_suppkey"), WriteSpec(table, {"ds": "even"}))
    odd = rows.where(~even).select("s_suppkey")
    write_table(odd, WriteSpec(table, {"ds": "odd"}))
    replacement = WriteSpec(table, {"ds": "odd"}, replace_partition=True)
    write_table(odd.where(F.col("s_suppkey") % 2 == 0), replacement)
    return read_table(spark, ReadSpec(table=table))


@query(
    """SELECT p_partkey, p_name FROM part
       UNION ALL SELECT p_partkey, p_name FROM part"""
)
def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unchecked writes add to what is there."""
    table = create_table(spark, "parts", "p_partkey bigint, p_name string")
    parts = given(spark, sf_dir, "part", "p_partkey", "p_name")
    for _ in range(2):
        write_table(parts, WriteSpec(table), check=False)
    return read_table(spark, ReadSpec(table=table))


@query(
    """SELECT CAST(c_nationkey AS BIGINT) AS l1, CAST(c_nationkey AS FLOAT) AS f1,
              CAST(c_nationkey AS DOUBLE) AS d1, CAST(NULL AS VARCHAR) AS s1 FROM customer"""
)
def widen_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = create_table(spark, "wide", "l1 bigint, f1 float, d1 double, s1 string")
    nation = F.col("c_nationkey")
    rows = given(spark, sf_dir, "customer", "c_nationkey").select(
        nation.alias("l1"), nation.alias("f1"), nation.alias("d1")
    )
    write_table(rows, WriteSpec(table))
    return read_table(spark, ReadSpec(table=table))


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) + l_partkey AS list_sum,
              CAST(l_linenumber AS DOUBLE) AS line, l_partkey AS part FROM lineitem"""
)
def widen_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists widen by element; a map becomes a struct by field name."""
    lines = given(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    rows = lines.select(
        "l_orderkey",
        F.array(F.col("l_linenumber"), F.col("l_partkey").cast("int")).alias("numbers"),
        F.create_map(
            F.lit("line"), F.col("l_linenumber").cast("bigint"), F.lit("part"), F.col("l_partkey")
        ).alias("place"),
    )
    schema = "l_orderkey bigint, numbers array<bigint>, place struct<line:double,part:bigint>"
    wide = upgrade_to(rows, T.DataType.fromDDL(schema))
    total = F.aggregate("numbers", F.lit(0).cast("bigint"), lambda a, b: a + b)
    return wide.select("l_orderkey", total.alias("list_sum"), "place.line", "place.part")


_MATRIX_KINDS = {
    "BYTE": "tinyint", "SHORT": "smallint", "INT": "int", "LONG": "bigint",
    "FLOAT": "float", "DOUBLE": "double", "STRING": "string", "BOOLEAN": "boolean",
}


@query(
    """SELECT s.k AS from_kind, d.k AS to_kind,
              (CASE WHEN s.r > 6 OR d.r > 6 THEN s.k = d.k ELSE s.r <= d.r END) AS allowed,
              (CASE WHEN s.r > 6 OR d.r > 6 THEN s.k = d.k ELSE s.r <= d.r END)::INT * t.n
              AS num_values
       FROM (VALUES ('BYTE',1),('SHORT',2),('INT',3),('LONG',4),('FLOAT',5),('DOUBLE',6),
                    ('STRING',9),('BOOLEAN',10)) s(k,r),
            (VALUES ('BYTE',1),('SHORT',2),('INT',3),('LONG',4),('FLOAT',5),('DOUBLE',6),
                    ('STRING',9),('BOOLEAN',10)) d(k,r),
            (SELECT CAST(sum(l_linenumber) AS BIGINT) AS n FROM lineitem) t"""
)
def widening_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of kinds, with what the widened line numbers of the whole table add up to."""
    lines = given(spark, sf_dir, "lineitem", "l_linenumber")
    number = F.col("l_linenumber")
    totals, allowed = [], []
    for from_kind, from_type in _MATRIX_KINDS.items():
        for to_kind, to_type in _MATRIX_KINDS.items():
            source, target = (T.DataType.fromDDL(t) for t in (from_type, to_type))
            name = f"{from_kind}_{to_kind}"
            allowed.append((name, from_kind, to_kind, can_widen(source, target)))
            totals.append(_total_after_widening(number, source, target).alias(name))
    sums = lines.agg(*totals).unpivot([], [row[0] for row in allowed], "pair", "num_values")
    # one row per pair of kinds
    pairs = spark.createDataFrame(
        allowed, "pair string, from_kind string, to_kind string, allowed boolean"
    )
    return sums.join(F.broadcast(pairs), "pair").select(
        "from_kind", "to_kind", "allowed", "num_values"
    )


def _total_after_widening(number: Column, source: T.DataType, target: T.DataType) -> Column:
    """Sum of the numbers after a round through ``target``; 0 where that is refused."""
    boolean = isinstance(source, T.BooleanType)
    given_as = (number > 0) if boolean else number.cast(source)
    try:
        wide = widen(given_as, source, target)
    except WideningError:
        return F.lit(0).cast("bigint")
    return F.sum(F.when(wide, number) if boolean else wide.cast("bigint"))


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def strict_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.DataType.fromDDL("c_custkey bigint, c_name string, c_nationkey int")
    rows = given(spark, sf_dir, "customer", "c_nationkey", "c_name", "c_custkey")
    return set_exact(rows, schema)


@query(
    """SELECT DISTINCT 'lang=' || lang || '/source=' || CASE WHEN doc_id % 5 IN (0, 1)
              THEN '__HIVE_DEFAULT_PARTITION__' ELSE source END AS path FROM documents"""
)
def partition_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory of each pair of keys; null and empty values have a level of their own."""
    documents = given(spark, sf_dir, "documents", "doc_id", "lang", "source")
    nothing = F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") % 5 == 1, "").otherwise(F.col("source"))
    keys = documents.select("lang", nothing.alias("source")).distinct()
    return keys.select(
        path_of({"lang": F.col("lang"), "source": F.col("source")}).alias("path")
    ).distinct()


def _outcome(write: Callable[[], None]) -> str:
    try:
        write()
    except OutputCheckError:
        return "rejected"
    return "accepted"


@query(
    """SELECT c.case_name, c.outcome, c.copies * t.n AS num_rows
       FROM (VALUES ('missing_table','rejected',0), ('needs_partition','rejected',1),
                    ('extra_partition','rejected',1), ('partition_exists','rejected',1),
                    ('table_not_empty','rejected',1), ('bucketed_table','rejected',0),
                    ('wrong_key','rejected',1), ('new_partition','accepted',2),
                    ('replaced_partition','accepted',2)) c(case_name,outcome,copies),
            (SELECT count(*) AS n FROM supplier) t"""
)
def output_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each check, and the rows its target holds afterwards: a refused write changes nothing."""
    rows = _suppliers(spark, sf_dir)
    partitioned = create_table(spark, "by_day", SUPPLIER, ("ds",))
    write_table(rows, WriteSpec(partitioned, {"ds": "2024-01-01"}))
    plain = create_table(spark, "plain", SUPPLIER)
    write_table(rows, WriteSpec(plain))
    bucketed = f"{plain.split('.')[0]}.bucketed"
    spark.sql(
        f"CREATE TABLE {quote_table(bucketed)} ({SUPPLIER}) USING parquet "
        "CLUSTERED BY (s_suppkey) SORTED BY (s_suppkey) INTO 4 BUCKETS"
    )
    cases = [
        ("missing_table", WriteSpec(f"{plain}_missing")),
        ("needs_partition", WriteSpec(partitioned)),
        ("extra_partition", WriteSpec(plain, {"ds": "2024-01-02"})),
        ("partition_exists", WriteSpec(partitioned, {"ds": "2024-01-01"})),
        ("table_not_empty", WriteSpec(plain)),
        ("bucketed_table", WriteSpec(bucketed)),
        ("wrong_key", WriteSpec(partitioned, {"day": "2024-01-02"})),
        ("new_partition", WriteSpec(partitioned, {"ds": "2024-01-02"})),
        ("replaced_partition", WriteSpec(partitioned, {"ds": "2024-01-02"}, True)),
    ]
    results = []
    for name, spec in cases:
        outcome = _outcome(lambda spec=spec: write_table(rows, spec))
        exists = spark.catalog.tableExists(spec.table)
        results.append((name, outcome, spark.table(spec.table).count() if exists else 0))
    return spark.createDataFrame(results, "case_name string, outcome string, num_rows bigint")


@query(
    """SELECT l_orderkey AS i1, l_partkey AS i2, l_suppkey AS i3, '2013-04-01' AS ds
       FROM lineitem"""
)
def map_only_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = create_table(spark, "line_keys", LINE_KEYS, ("ds",))
    spec = WriteSpec(table, {"ds": "2013-04-01"})
    map_only_job(lineitem_positions(spark, sf_dir), "positions", spec)
    return read_table(spark, ReadSpec(table=table))


@query("SELECT s_suppkey, s_name, s_acctbal, '2013-04-01' AS ds FROM supplier")
def parallel_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = create_table(spark, "suppliers", SUPPLIER, ("ds",))
    output_job(_suppliers(spark, sf_dir), WriteSpec(table, {"ds": "2013-04-01"}), writers=4)
    return read_table(spark, ReadSpec(table=table))


@query(
    """SELECT o_orderkey, o_custkey, true AS within_bound FROM orders"""
)
def bounded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new file after a thousand rows."""
    table = create_table(spark, "orders_in_pieces", "o_orderkey bigint, o_custkey bigint")
    orders = given(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    write_table(orders, WriteSpec(table, max_records_per_file=1000))
    position = F.col("_metadata.row_index")
    return spark.table(table).select(
        "o_orderkey", "o_custkey", (position < 1000).alias("within_bound")
    )


@query(
    """SELECT doc_id, octet_length(encode(text)) AS text_bytes, true AS within_bound
       FROM documents"""
)
def byte_bounded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of whole texts, a word or a book long, none of them larger than a megabyte."""
    most = 1 << 20
    table = create_table(spark, "texts_in_pieces", "doc_id bigint, text string")
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    write_table(docs, WriteSpec(table, max_bytes_per_file=most))
    return spark.table(table).select(
        "doc_id",
        F.octet_length("text").cast("long").alias("text_bytes"),
        (F.col("_metadata.file_size") <= most).alias("within_bound"),
    )


@query(
    """SELECT 'vertex' AS profile, c_custkey AS id FROM customer
       UNION ALL SELECT 'edge', o_orderkey FROM orders"""
)
def write_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two outputs of one job."""
    inputs = {
        "vertex": given(spark, sf_dir, "customer", "c_custkey").toDF("id"),
        "edge": given(spark, sf_dir, "orders", "o_orderkey").toDF("id"),
    }
    specs = {name: WriteSpec(create_table(spark, name, "id bigint")) for name in inputs}
    write_named(spark, {name: (rows, specs[name]) for name, rows in inputs.items()})
    outputs = [
        read_table(spark, ReadSpec(table=spec.table)).select(F.lit(name).alias("profile"), "id")
        for name, spec in specs.items()
    ]
    return reduce(DataFrame.unionByName, outputs)


@query(
    """SELECT 'edges' AS output, o_orderkey AS id, o_custkey AS other, o_totalprice AS weight, NULL AS ds
       FROM orders
       UNION ALL SELECT 'vertices', o_custkey, NULL, NULL, NULL FROM orders WHERE o_orderstatus <> 'P'
       UNION ALL SELECT 'open', o_orderkey, NULL, NULL, 'O' FROM orders WHERE o_orderstatus = 'O'"""
)
def joint_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three outputs with columns and rows of their own, from one pass over their parent."""
    orders = given(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    edges = create_table(spark, "edges", "id bigint, other bigint, weight double")
    vertices = create_table(spark, "vertices", "id bigint")
    opened = create_table(spark, "opened", "id bigint", ("ds",))
    order, customer, status = F.col("o_orderkey").alias("id"), F.col("o_custkey"), F.col("o_orderstatus")
    write_outputs(
        orders,
        {
            "edges": Output(WriteSpec(edges), (order, customer.alias("other"), F.col("o_totalprice").alias("weight"))),
            "vertices": Output(WriteSpec(vertices), (customer.alias("id"),), status != "P"),
            "open": Output(WriteSpec(opened, {"ds": "O"}), (order,), status == "O"),
        },
    )
    outputs = {"edges": edges, "vertices": vertices, "open": opened}
    rows = [read_table(spark, ReadSpec(table=t)).withColumn("output", F.lit(n)) for n, t in outputs.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


@query(
    """SELECT 1 AS accepted, 2 AS rejected, 1 AS failed, count(*) AS num_rows, 1 AS num_partitions FROM supplier"""
)
def claimed_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three writers of one new partition at once, of which two are refused; a failing writer leaves no partition."""
    rows = _suppliers(spark, sf_dir)
    table = create_table(spark, "claimed", SUPPLIER, ("ds",))
    bad = rows.withColumn("s_name", F.raise_error(F.lit("no name")).cast("string"))

    def write(chosen: DataFrame, day: str) -> str:
        try:
            return _outcome(lambda: write_table(chosen, WriteSpec(table, {"ds": day})))
        except Exception:  # noqa: BLE001
            return "failed"

    with ThreadPoolExecutor(4) as pool:
        jobs = [(rows, "2024-01-01")] * 3 + [(bad, "2024-01-02")]
        outcomes = list(pool.map(lambda job: write(*job), jobs))
    counts = read_table(spark, ReadSpec(table=table)).agg(F.count(F.lit(1)).alias("num_rows"))
    partitions = partitions_of(spark, ReadSpec(table=table)).count()
    return counts.select(
        *(F.lit(outcomes.count(name)).alias(name) for name in ("accepted", "rejected", "failed")),
        "num_rows", F.lit(partitions).alias("num_partitions"),
    )


@query(
    """SELECT f.format, c_custkey, c_name, c_acctbal FROM customer,
       (VALUES ('parquet'), ('orc'), ('json'), ('csv')) f(format)"""
)
def storage_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows through every storage format a table may declare."""
    customers = given(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal")
    outputs = []
    for using in ("parquet", "orc", "json", "csv"):
        table = create_table(spark, f"in_{using}", customers.schema, using=using)
        write_table(customers, WriteSpec(table))
        rows = read_table(spark, ReadSpec(table=table))
        outputs.append(rows.select(F.lit(using).alias("format"), *customers.columns))
    return reduce(DataFrame.unionByName, outputs)


@query(
    """SELECT count(*) AS num_rows, count(*) FILTER (WHERE o_custkey % 7 = 0) AS null_customers
       FROM orders"""
)
def observed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row and null counts collected while the rows are written."""
    table = create_table(spark, "orders_seen", "o_orderkey bigint, o_custkey bigint")
    customer = F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey"))
    rows = given(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    seen = Observation()
    write_table(rows.withColumn("o_custkey", customer), WriteSpec(table), observation=seen)
    metrics = seen.get
    return spark.createDataFrame(
        [(metrics["rows"], metrics["o_custkey_nulls"])], "num_rows bigint, null_customers bigint"
    )
