"""Scans, sinks, lineage and catalogue on the driver tables."""

from __future__ import annotations

import uuid

from datetime import datetime, timezone

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisalake.functions import exact_sum, record_hash
from brisalake.operators.conform import required_columns
from brisalake.plans.lake import TABLES, Lake
from brisalake.plans.marts import mart_indicator
from brisalake.plans.oracle import big, xavg, xsum
from brisalake.plans.registry import query
from brisalake.sources.catalog import (
    dashboard_view, external_table, layer_inventory, manifest, register_views, sql_over_lake, table_profile)
from brisalake.sources.footprint import format_size_compare, layer_footprint, scan_bytes_report
from brisalake.sources.lineage import changed_records, lineage_columns
from brisalake.sources.readers import (
    first_readable, flatten_json, optional_columns, pruned_extract, quarantine, scan_csv, scan_csv_checked, scan_parquet)
from brisalake.sources.writers import (
    append_merge_schema, compact_cluster, export_csv_locale, write_compact, write_json_events,
    write_partitioned, write_table)

RUN = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)


@query("scan_csv", "SELECT id_municipio, nome_municipio, rede, rede_nome, sigla_uf, nome_regiao FROM unit")
def _(k: Lake):
    cols = ["id_municipio", "nome_municipio", "rede", "rede_nome", "sigla_uf", "nome_regiao"]
    path = f"{k.work}/units_csv"
    k.units.select(*cols).write.option("header", True).csv(path)
    return scan_csv(k.spark, path).withColumn("id_municipio", F.col("id_municipio").cast("bigint"))


@query("scan_parquet", f"""SELECT l_linestatus, COUNT(*) AS n, {xsum("l_quantity")} AS quantity,
       strftime(MIN(l_shipdate), '%Y-%m-%d') AS first_ship FROM lineitem GROUP BY 1""")
def _(k: Lake):
    return scan_parquet(k.spark, k.path("lineitem")).groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("l_quantity").alias("quantity"),
        F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("first_ship"))


@query("flatten_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k FROM events")
def _(k: Lake):
    return flatten_json(k.table("events").select("event_id", "props"), "props", "k bigint")


NESTED = """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN user_id END AS doc_user_id, CASE WHEN event_id % 3 = 0 THEN event_type END AS doc_user_kind,
       CASE WHEN event_id % 3 = 1 THEN value END AS doc_m_v, CASE WHEN event_id % 3 = 1 THEN CAST(event_id AS VARCHAR) END AS doc_m_deep_e_x,
       CASE WHEN event_id % 3 = 2 THEN CAST(event_id AS VARCHAR) WHEN event_id % 3 = 1 THEN 'text' END AS doc_mixed FROM events"""


@query("flatten_json_merged", NESTED)
def _(k: Lake):
    """Three shapes of document without a declared schema: the columns are the union of their fields."""
    e = k.table("events")
    name = lambda c, n: F.col(c).alias(n)
    doc = F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(F.struct(name("user_id", "id"), name("event_type", "kind")).alias("user")))) \
        .when(F.col("event_id") % 3 == 1, F.to_json(F.struct(
            F.struct(name("value", "v"), F.struct(F.col("event_id").cast("string").alias("e.x")).alias("deep")).alias("m"), F.lit("text").alias("mixed")))) \
        .otherwise(F.to_json(F.struct(name("event_id", "mixed"))))
    return flatten_json(e.select("event_id", doc.alias("doc")), "doc")


@query("scan_csv_quarantine", """SELECT 'boa' AS parte, CAST(NULL AS VARCHAR) AS motivo, COUNT(*) AS n, SUM(c_custkey)::BIGINT AS soma FROM customer
       WHERE c_custkey % 50 NOT IN (1, 2, 3, 4)
       UNION ALL SELECT 'quarentena', CASE c_custkey % 50 WHEN 1 THEN 'campos:3' WHEN 2 THEN 'tipo:saldo' WHEN 3 THEN 'campos:5' ELSE 'nulo:id' END,
       COUNT(*), NULL FROM customer WHERE c_custkey % 50 IN (1, 2, 3, 4) GROUP BY ALL""")
def _(k: Lake):
    """A landing file of every customer, four of fifty rows defective: too few fields, no number, too many fields, no key."""
    c, case = k.table("customer"), F.col("c_custkey") % 50
    key, name, nation = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_nationkey").cast("string")
    line = F.concat_ws("|", F.when(case == 4, "").otherwise(key), F.concat(F.lit('"'), name, F.lit('|x"')), nation,
                       F.when(case == 1, F.lit(None)).when(case == 2, "abc").otherwise(F.col("c_acctbal").cast("string")),
                       F.when(case == 3, "more"))
    path = f"{k.work}/landing"
    c.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("nome", T.StringType()),
                           T.StructField("uf", T.IntegerType()), T.StructField("saldo", T.DoubleType())])
    good, bad = scan_csv_checked(k.spark, path, schema, "|", header=False)
    kept = quarantine(bad, f"{k.work}/quarantine", "run-1")
    n = F.count(F.lit(1)).alias("n")
    return good.agg(n, F.sum("id").alias("soma")).select(F.lit("boa").alias("parte"), F.lit(None).cast("string").alias("motivo"), "n", "soma").unionByName(
        kept.groupBy(F.col("_reason").alias("motivo")).agg(n).withColumns({"parte": F.lit("quarentena"), "soma": F.lit(None).cast("bigint")}))


@query("first_readable", "SELECT 'csv' AS _source, COUNT(*) AS n, SUM(p_partkey)::BIGINT AS soma FROM part")
def _(k: Lake):
    """The table is landed as CSV only; the Parquet export that is asked for first is missing."""
    path = f"{k.work}/part_csv"
    k.table("part").select("p_partkey", "p_name").write.option("header", True).csv(path)
    found = first_readable([("parquet", lambda: scan_parquet(k.spark, f"{k.work}/part_parquet")),
                            ("csv", lambda: scan_csv(k.spark, path, "p_partkey bigint, p_name string"))])
    return found.groupBy("_source").agg(F.count(F.lit(1)).alias("n"), F.sum("p_partkey").alias("soma"))


@query("optional_columns", "SELECT p_partkey, p_size, CAST(NULL AS VARCHAR) AS p_container, 0 AS p_stock FROM part")
def _(k: Lake):
    part = k.table("part").select("p_partkey", "p_size")
    return optional_columns(part, {"p_container": ("string", None), "p_stock": ("int", 0), "p_size": ("int", -1)})


@query("pruned_extract", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE year(o_orderdate) IN (1996, 1999)""")
def _(k: Lake):
    return pruned_extract(k.table("orders"), ["o_orderkey", "o_custkey", "o_totalprice"], "o_orderdate", [1996, 1999])


@query("lineage_columns", """SELECT c_custkey, '2024-05-06T07:08:09+00:00' AS _ingestion_timestamp,
       '2024-05-06' AS _ingestion_date, 'customer.parquet' AS _source, 'parquet' AS _source_format,
       'customer' AS _entity, '20240506_070809' AS _pipeline_run_id, '2024' AS ano_ingestao,
       '05' AS mes_ingestao, '06' AS dia_ingestao FROM customer""")
def _(k: Lake):
    out = lineage_columns(k.table("customer"), "customer", "customer.parquet", "parquet", RUN)
    return out.drop("_record_hash", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("record_hash", """SELECT n_nationkey, sha256(concat_ws('|', length(n_name) || ':' || n_name,
       length(n_nationkey::VARCHAR) || ':' || n_nationkey, length(n_regionkey::VARCHAR) || ':' || n_regionkey)) AS h FROM nation""")
def _(k: Lake):
    nation = k.table("nation").withColumn("_loaded", F.lit("x"))
    return nation.select("n_nationkey", record_hash(nation.columns).alias("h"))


@query("changed_records", """WITH o AS (SELECT c_custkey, c_acctbal FROM customer), n AS (
       SELECT c_custkey, c_acctbal + CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS c_acctbal
       FROM customer WHERE c_custkey % 7 <> 0
       UNION ALL SELECT c_custkey + 10000000000, c_acctbal FROM customer WHERE c_custkey % 11 = 0)
       SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN o.c_custkey IS NULL THEN 'new'
       WHEN n.c_custkey IS NULL THEN 'gone' WHEN o.c_acctbal = n.c_acctbal THEN 'same' ELSE 'changed' END AS change
       FROM o FULL JOIN n ON o.c_custkey = n.c_custkey""")
def _(k: Lake):
    old, key = k.table("customer"), F.col("c_custkey")
    edited = old.filter(key % 7 != 0).withColumn(
        "c_acctbal", F.col("c_acctbal") + F.when(key % 10 == 0, 1.0).otherwise(0.0))
    added = old.filter(key % 11 == 0).withColumn("c_custkey", key + 10000000000)
    return changed_records(old, edited.unionByName(added), ["c_custkey"])


@query("write_partitioned", f"""SELECT CAST(year(o_orderdate) AS INT) AS ano, COUNT(*) AS n,
       {xsum("o_totalprice")} AS total FROM orders GROUP BY 1""")
def _(k: Lake):
    orders = k.table("orders").withColumn("ano", F.year("o_orderdate"))
    path = f"{k.work}/orders_by_year"
    write_partitioned(orders, path, ["ano"], spread="o_orderkey", files_per_partition=4)
    write_partitioned(orders.filter(F.col("ano") >= 1999), path, ["ano"], spread="o_orderkey", files_per_partition=4)
    return scan_parquet(k.spark, path).groupBy("ano").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total"))


@query("write_table", "SELECT r_regionkey, r_name FROM region")
def _(k: Lake):
    name, path = f"brisalake_region_{uuid.uuid4().hex[:8]}", f"{k.work}/region_table"
    write_table(k.table("region").select("r_regionkey"), name, path)
    write_table(k.table("region"), name, path)
    return k.spark.table(name)


@query("append_merge_schema", """SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN value END AS value
       FROM events""")
def _(k: Lake):
    events, path = k.table("events"), f"{k.work}/grown"
    even = F.col("event_id") % 2 == 0
    append_merge_schema(events.filter(even).select("event_id", "user_id"), path)
    append_merge_schema(events.filter(~even).select("event_id", "user_id", "value"), path)
    return scan_parquet(k.spark, path, merge_schema=True)


@query("write_compact", f"SELECT {big('1')} AS files, COUNT(*) AS n FROM region")
def _(k: Lake):
    path = write_compact(k.table("region"), f"{k.work}/compact")
    return scan_parquet(k.spark, path).select(F.input_file_name().alias("file")).agg(
        F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n"))


@query("write_json_events", """SELECT id_evento, tipo_evento, ts_evento, CAST(id_municipio AS BIGINT) AS id_municipio,
       rede, proficiencia_portugues, peso_aluno, _defeito_injetado FROM ev0""")
def _(k: Lake):
    cols = ["id_evento", "tipo_evento", "ts_evento", "id_municipio", "rede", "proficiencia_portugues",
            "peso_aluno", "_defeito_injetado"]
    events = k.events.select(*cols)
    path = write_json_events(events, f"{k.work}/json_events")
    return k.spark.read.schema(events.schema).json(path)


@query("export_csv_locale", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       replace(CAST(c_acctbal AS VARCHAR), '.', ',') AS c_acctbal FROM customer""")
def _(k: Lake):
    rows = k.table("customer").select("c_custkey", "c_name", "c_acctbal")
    path = export_csv_locale(rows, f"{k.work}/export")
    return scan_csv(k.spark, path, "c_custkey string, c_name string, c_acctbal string", ";")


_sizes = " UNION ALL ".join(
    f"SELECT '{t}' AS entity, COUNT(*) AS rows, (SELECT COUNT(*) FROM (DESCRIBE SELECT * FROM {t})) AS columns FROM {t}"
    for t in TABLES)


@query("manifest", _sizes)
def _(k: Lake):
    return manifest(k.spark, {t: (k.path(t), "parquet") for t in TABLES}, "run-1").select("entity", "rows", "columns")


@query("layer_inventory", f"""WITH s AS ({_sizes}) SELECT 'landing' AS layer, entity AS "table", rows, columns FROM s
       UNION ALL SELECT 'TOTAL', '', CAST(SUM(rows) AS BIGINT), CAST(SUM(columns) AS BIGINT) FROM s""")
def _(k: Lake):
    return layer_inventory(k.spark, {"landing": {t: k.path(t) for t in TABLES}}).select(
        "layer", "table", "rows", "columns")


_num = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("table_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", 0.0 AS null_pct, CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max,
        {xavg(c)} AS mean FROM lineitem""" for c in _num) + "".join(
    f""" UNION ALL SELECT '{c}', 0.0, NULL, NULL, NULL FROM (SELECT 1)""" for c in (
        "l_returnflag", "l_linestatus", "l_shipdate")))
def _(k: Lake):
    return table_profile(k.table("lineitem")).select("column", "null_pct", "min", "max", "mean")


@query("register_views", " UNION ALL ".join(f"SELECT '{t}' AS view, COUNT(*) AS n FROM {t}" for t in sorted(TABLES)))
def _(k: Lake):
    made = register_views(k.spark, {**{f"lake_{t}": k.path(t) for t in TABLES}, "lake_absent": f"{k.folder}/absent"})
    rows = [k.spark.table(v).agg(F.count(F.lit(1)).alias("n")).select(F.lit(v[5:]).alias("view"), "n")
            for v in sorted(made)]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@query("external_table", """SELECT CAST(year(o_orderdate) AS INT) AS ano, o_orderstatus, COUNT(*) AS n
       FROM orders GROUP BY ALL""")
def _(k: Lake):
    orders = k.table("orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("ano"))
    path = write_partitioned(orders, f"{k.work}/orders_ext", ["ano"], "o_orderkey", 4)
    name, columns = f"brisalake_orders_{uuid.uuid4().hex[:8]}", "o_orderkey BIGINT, o_orderstatus STRING, ano INT"
    late = orders.filter("ano >= 1998")
    external_table(k.spark, name, columns, ["ano"], path, orders.filter("ano < 1998"))
    table = external_table(k.spark, name, columns, ["ano"], path, late)  # a second write registers what it brings
    return table.groupBy("ano", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


_panel = ["ano", "sigla_uf", "nome_regiao", "nome_municipio", "rede_nome", "taxa_alfabetizacao", "meta_taxa_ano",
          "gap_meta_ano", "gap_meta_2030", "risco_alfabetizacao", "situacao_meta", "posicao_na_uf"]


@query("dashboard_view", f"""SELECT {', '.join(_panel)} FROM indicator WHERE rede_nome IN ('BUILDING', 'HOUSEHOLD')""")
def _(k: Lake):
    return dashboard_view(k.spark, "vw_painel_alfabetizacao", mart_indicator(k.integrated), _panel,
                          F.col("rede_nome").isin("BUILDING", "HOUSEHOLD"))


_lake_sql = f"""SELECT o_orderpriority, COUNT(*) AS n, {xsum("l_extendedprice * (1 - l_discount)")} AS revenue
                FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority"""


@query("sql_over_lake", _lake_sql)
def _(k: Lake):
    register_views(k.spark, {"lake_lineitem": k.path("lineitem"), "lake_orders": k.path("orders")})
    return sql_over_lake(k.spark, """
        SELECT o_orderpriority, COUNT(*) AS n,
               CAST(SUM(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(28, 4))) AS DOUBLE) AS revenue
        FROM lake_lineitem JOIN lake_orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""")


@query("required_columns", "SELECT p_brand, COUNT(*) AS n FROM part GROUP BY 1")
def _(k: Lake):
    part = k.table("part")
    required_columns(part, ["p_partkey", "p_brand"])
    return part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("scan_bytes_report")
def _(k: Lake):
    orders = k.table("orders").withColumn("ano", F.year("o_orderdate"))
    text, cols = f"{k.work}/orders.csv", ["o_orderkey", "o_orderstatus", "o_totalprice"]
    orders.write.option("header", True).csv(text)
    lake = write_partitioned(orders, f"{k.work}/orders_scan", ["ano"], "o_orderkey", 4)
    return scan_bytes_report(k.spark, {
        "text scan": (text, None, None), "all columns": (lake, None, None),
        "one partition": (lake, "ano=2000", None), "one partition, needed columns": (lake, "ano=2000", cols)})


@query("format_size_compare")
def _(k: Lake):
    return format_size_compare(k.table("lineitem"), f"{k.work}/formats")


@query("layer_footprint")
def _(k: Lake):
    for layer, name in (("bronze", "orders"), ("bronze", "customer"), ("silver", "lineitem")):
        k.table(name).write.parquet(f"{k.work}/{layer}/{name}")
    return layer_footprint(k.spark, {x: f"{k.work}/{x}" for x in ("bronze", "silver")})


@query("compact_cluster", """SELECT CAST(year(o_orderdate) AS INT) AS ano, o_orderstatus, COUNT(*) AS n,
       MIN(o_orderkey) AS lo, MAX(o_orderkey) AS hi FROM orders GROUP BY ALL""")
def _(k: Lake):
    orders = k.table("orders").withColumn("ano", F.year("o_orderdate"))
    path = compact_cluster(orders, f"{k.work}/clustered", 16, ["ano", "o_orderstatus"])
    return scan_parquet(k.spark, path).groupBy("ano", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


@query("format_sizes_in_order", """SELECT f.pos AS lugar, f.name AS formato, COUNT(*) AS linhas FROM lineitem,
       (VALUES (1, 'Parquet + Snappy'), (2, 'CSV + gzip'), (3, 'CSV')) f(pos, name) GROUP BY ALL""")
def _(k: Lake):
    """Formats from the smallest, each read back to its number of rows."""
    li, folder = k.table("lineitem"), f"{k.work}/formats_read"
    sizes = format_size_compare(li, folder)
    place = F.row_number().over(Window.orderBy("bytes"))  # three rows
    text = lambda sub: k.spark.read.schema("l_orderkey string").option("header", True).csv(f"{folder}/{sub}")
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    rows = F.when(F.col("format") == "CSV", n(text("csv"))).when(F.col("format") == "CSV + gzip", n(text("csv_gz"))).otherwise(
        n(k.spark.read.parquet(f"{folder}/parquet")))
    return sizes.select(place.alias("lugar"), F.col("format").alias("formato"), rows.alias("linhas"))


@query("layer_tables", """SELECT * FROM (VALUES ('bronze', 'customer'), ('bronze', 'orders'), ('silver', 'lineitem')) t(layer, "table"),
       (SELECT COUNT(*) > 0 AS tem_bytes FROM orders)""")
def _(k: Lake):
    for layer, name in (("bronze", "orders"), ("bronze", "customer"), ("silver", "lineitem")):
        k.table(name).write.parquet(f"{k.work}/inventory/{layer}/{name}")
    found = layer_footprint(k.spark, {x: f"{k.work}/inventory/{x}" for x in ("bronze", "silver")})
    return found.select("layer", "table", ((F.col("bytes") > 0) & (F.col("files") > 0)).alias("tem_bytes"))
