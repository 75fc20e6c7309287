"""Files: naming, text scan, schema evolution, lineage, hashes, round trips, extracts."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.inputs import RAW, Inputs
from checks.registry import query
from lakestrata.functions.dates import dataset_of_file
from lakestrata.operators import quality
from lakestrata.plans.run import QUARANTINED
from lakestrata.schemas import DATASETS
from lakestrata.session import in_parallel, materialise, new_shared_path, remove, setting
from lakestrata.sources import drops
from lakestrata.sources.layers import as_records, read_layer, write_layer

#: Datasets with line breaks inside cells.
_LINE_BREAKS = {"gbp_reviews"}
_ALL_FILES = " UNION ALL ".join(f"SELECT source_file FROM raw_{d}" for d in RAW)


#: Rows of a compressed extract, which one task reads.
ROWS_OF_EXTRACT = 500_000


def _write_csv(df: DataFrame, path: str, compressed: bool = False) -> None:
    writer = df.write.option("header", "true").option("escape", '"').option("emptyValue", "")
    writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    if compressed:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", ROWS_OF_EXTRACT)
    writer.csv(path)


def _files(inputs: Inputs, path: str, suffix: str = ".csv") -> list[str]:
    return sorted(p for paths in drops.discover(inputs.spark, path, suffix).values() for p in paths)


@query(
    "dataset_from_file_name",
    f"""SELECT regexp_replace(source_file, '^(z_)?(.+)_[0-9]{{4}}_[0-9]{{2}}[.]csv$', '\\1\\2') AS dataset,
               count(*) AS row_count, count(DISTINCT source_file) AS files
        FROM ({_ALL_FILES}) GROUP BY 1""",
)
def dataset_from_file_name(inputs: Inputs) -> DataFrame:
    files = reduce(DataFrame.unionByName, [inputs.raw(d).select("source_file") for d in RAW])
    per_file = files.groupBy("source_file").agg(F.count("*").alias("n"))
    return per_file.groupBy(dataset_of_file(F.col("source_file")).alias("dataset")).agg(
        F.sum("n").alias("row_count"), F.count("*").alias("files")
    )


@query(
    "csv_text_scan",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, md5(text) AS text_md5, CAST(length(text) AS INT) AS text_length FROM documents",
)
def csv_text_scan(inputs: Inputs) -> DataFrame:
    """Whole texts, with line breaks and quotes, written as CSV and scanned as text."""
    path = new_shared_path(inputs.spark, "documents_csv")
    columns = ["doc_id", "lang", "source", "text"]
    _write_csv(inputs.table("documents").select(*columns), path)
    scanned = drops.scan_text(inputs.spark, _files(inputs, path), columns, multiline=True)
    return scanned.select(
        "doc_id", "lang", "source", F.md5("text").alias("text_md5"), F.length("text").alias("text_length")
    )


def _evolving_drop(inputs: Inputs) -> DataFrame:
    """Orders in three files layouts: other columns, and the same columns in another order."""
    path = new_shared_path(inputs.spark, "orders_csv")
    orders = inputs.table("orders")
    layouts = {
        "F": ["o_orderkey", "o_custkey", "o_orderstatus"],
        "O": ["o_orderstatus", "o_orderpriority", "o_orderkey"],
        "P": ["o_orderkey", "o_orderpriority", "o_custkey", "o_orderstatus"],
    }
    for state, columns in layouts.items():
        rows = orders.filter(F.col("o_orderstatus") == state)
        _write_csv(rows.select(*columns), f"{path}/{state}")
    batch_id, now = drops.new_batch()
    return drops.read_dataset(inputs.spark, "sales_orders", _files(inputs, path), path, batch_id, now)


@query(
    "union_by_name_evolving",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
              CASE WHEN o_orderstatus <> 'O' THEN CAST(o_custkey AS VARCHAR) END AS o_custkey,
              CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
       FROM orders""",
)
def union_by_name_evolving(inputs: Inputs) -> DataFrame:
    return _evolving_drop(inputs).select("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority")


@query(
    "lineage_columns",
    """SELECT 'sales' AS source_system, o_orderstatus AS folder, count(*) AS row_count,
              CAST(1 AS BIGINT) AS batches, CAST(1 AS BIGINT) AS timestamps, count(*) AS hashed
       FROM orders GROUP BY o_orderstatus""",
)
def lineage_columns(inputs: Inputs) -> DataFrame:
    rows = _evolving_drop(inputs)
    return rows.groupBy("source_system", F.split("source_file", "/")[0].alias("folder")).agg(
        F.count("*").alias("row_count"),
        F.count_distinct("batch_id").alias("batches"),
        F.count_distinct("ingestion_timestamp").alias("timestamps"),
        F.count_if(F.length("row_hash") == 64).alias("hashed"),
    )


@query(
    "row_hash",
    """SELECT doc_id, sha256(CAST(to_json([['doc_id', CAST(doc_id AS VARCHAR)], ['lang', lang], ['text', text]]) AS VARCHAR)) AS row_hash
       FROM documents""",
)
def row_hash(inputs: Inputs) -> DataFrame:
    rows = inputs.table("documents").select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "text")
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        drops.row_hash(["doc_id", "lang", "text"]).alias("row_hash"),
    )


@query(
    "parquet_roundtrip",
    """SELECT l_returnflag, l_linestatus, count(*) AS row_count, CAST(sum(l_quantity) AS DOUBLE) AS quantity,
              CAST(min(l_shipdate) AS DATE)::VARCHAR AS first_ship, count(DISTINCT l_orderkey) AS orders
       FROM lineitem GROUP BY ALL""",
)
def parquet_roundtrip(inputs: Inputs) -> DataFrame:
    path = new_shared_path(inputs.spark, "lineitem")
    lineitem = inputs.table("lineitem")
    write_layer(lineitem, path)
    back = read_layer(inputs.spark, path, lineitem._jdf.schema().toDDL())
    return back.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("row_count"),
        F.sum("l_quantity").alias("quantity"),
        F.min(F.col("l_shipdate").cast("date")).alias("first_ship"),
        F.count_distinct("l_orderkey").alias("orders"),
    )


def _content_sql(dataset: str) -> str:
    """Rows and content of a raw dataset, as ``quality.fingerprint`` has them."""
    cells = [f"coalesce({c}, '')" for c in DATASETS[dataset]]
    digest = "md5(" + " || ".join(f"CAST(strlen({c}) AS VARCHAR) || ':' || {c}" for c in cells) + ")"
    sums = [f"CAST(coalesce(sum(CAST('0x' || substr({digest}, {at}, 15) AS BIGINT)), 0) AS VARCHAR)" for at in (1, 18)]
    return f"SELECT '{dataset}' AS dataset, count(*) AS n, {sums[0]} || '/' || {sums[1]} AS content FROM raw_{dataset}"


@query(
    "layer_reconciliation",
    "SELECT dataset, n AS raw_rows, n AS stored_rows, content, 'PASS' AS row_check, 'PASS' AS content_check, 'PASS' AS column_check FROM ("
    + " UNION ALL ".join(_content_sql(d) for d in RAW)
    + ")",
)
def layer_reconciliation(inputs: Inputs) -> DataFrame:
    """Raw rows and columns of every dataset, written as text extracts, against the good rows and
    the columns bronze holds after ingesting those. The content of what was stored is shown, which
    the other side works out from the tables.

    Extracts go once bronze is written, and bronze once its content is taken, so the disk holds two
    datasets at a time and not all; extracts are compressed but those with line breaks in cells,
    which are read by block.
    """
    spark = inputs.spark
    path = new_shared_path(spark, "reconciliation")
    batch_id, now = drops.new_batch()

    def content(dataset: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.lit(dataset).alias("dataset"), *quality.fingerprint(rows, DATASETS[dataset]))

    def ingest(dataset: str) -> tuple[DataFrame, list[str]]:
        extracts, layer = f"{path}/raw/{dataset}", f"{path}/bronze/{dataset}"
        blocks = dataset in _LINE_BREAKS
        _write_csv(inputs.raw(dataset).select(*DATASETS[dataset]), extracts, not blocks)
        files = _files(inputs, extracts, ".csv" if blocks else ".csv.gz")
        rows = drops.read_dataset(spark, dataset, files, extracts, batch_id, now, blocks)
        marked = rows.withColumn(QUARANTINED, F.col(drops.CORRUPT).isNotNull().cast("int"))
        write_layer(marked, layer, [QUARANTINED], compression="zstd")
        remove(spark, extracts)
        stored = read_layer(spark, layer)
        kept = materialise(content(dataset, stored.filter(F.col(QUARANTINED) == 0)), f"{dataset}_content")
        remove(spark, layer)
        return kept, stored.columns

    # Good and bad rows are two files of a task, open at once, so they need no sort before they are
    # written; and a task reads one extract, for a few compressed bytes are many rows.
    writers, one_file = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.files.openCostInBytes"
    with setting(spark, writers, "2"), setting(spark, one_file, spark.conf.get("spark.sql.files.maxPartitionBytes")):
        kept, columns_of = zip(*in_parallel(*[partial(ingest, d) for d in RAW], at_once=2))
    raw = [content(d, inputs.raw(d)) for d in RAW]
    rows = quality.reconcile_content(reduce(DataFrame.unionByName, raw), reduce(DataFrame.unionByName, kept))

    def names(frames) -> DataFrame:
        pairs = [(d, c) for d, columns in frames for c in columns]
        return spark.createDataFrame(pairs, "dataset string, column string")

    columns = quality.reconcile_columns(names((d, DATASETS[d]) for d in RAW), names(zip(RAW, columns_of)))
    report = materialise(rows.join(columns, "dataset", "left"), "reconciliation_report")
    remove(spark, path)
    return report


@query(
    "publish_json_records",
    """SELECT CAST(to_json({'resident_key': resident_key, 'change_date': change_date, 'previous_level': previous_level,
                            'new_level': new_level, 'reason': reason}) AS VARCHAR) AS record
       FROM fact_care_history""",
)
def publish_json_records(inputs: Inputs) -> DataFrame:
    return as_records(inputs.fact("fact_care_history"))
