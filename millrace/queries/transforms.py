"""Projections, lookups, masks, encryption and other column steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import add_audit_columns, nan_to_null, project
from millrace.functions.crypto import decrypt_columns, derived_key, encrypt, encrypt_columns, key_from_hex
from millrace.functions.mask import mask_alpha, mask_date, mask_from_config, mask_numeric
from millrace.operators.lookup import auto_correct
from millrace.operators.mutate import delete_where, update_where
from millrace.operators.order import row_index
from millrace.plans.features import apply_features
from millrace.queries.base import Shape, query, table

GAPPY = Shape(
    "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
    "case when c_custkey % 3 = 0 then null else 'given ' || cast(c_nationkey as string) end as nation_name",
)
# The lookup lacks three keys and has one twice.
_LOOKUP_SQL = "SELECT * FROM nation WHERE n_nationkey not in (3, 7, 11) UNION ALL SELECT n_nationkey, 'SECOND', n_regionkey FROM nation WHERE n_nationkey = 5"


def _lookup(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    second = nation.where("n_nationkey = 5").withColumn("n_name", F.lit("SECOND"))
    return nation.where("n_nationkey not in (3, 7, 11)").unionByName(second)


def _corrected(spark, sf_dir, how):
    return auto_correct(GAPPY.frame(spark, sf_dir), _lookup(spark, sf_dir), {"c_nationkey": "n_nationkey"}, {"nation_name": "n_name"}, how)


_OWN = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
_LEFT_SQL = f"""SELECT {_OWN}, coalesce(nation_name, n_name) as nation_name FROM ({GAPPY.sql}) g
    LEFT JOIN (SELECT n_nationkey, min(n_name) as n_name FROM ({_LOOKUP_SQL}) l GROUP BY 1) l ON c_nationkey = n_nationkey"""


@query("auto_correct_left", _LEFT_SQL)
def auto_correct_left(spark, sf_dir):
    return _corrected(spark, sf_dir, "left")


@query("auto_correct_inner", f"SELECT {_OWN}, coalesce(nation_name, n_name) as nation_name FROM ({GAPPY.sql}) g JOIN ({_LOOKUP_SQL}) l ON c_nationkey = n_nationkey")
def auto_correct_inner(spark, sf_dir):
    return _corrected(spark, sf_dir, "inner")


@query("auto_correct_two_keys", """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity,
    coalesce(case when l_orderkey % 5 = 0 then null else l_extendedprice end, price) as price
    FROM lineitem LEFT JOIN (SELECT l_partkey as p, l_suppkey as s, min(l_extendedprice) as price FROM lineitem GROUP BY 1, 2) k ON l_partkey = p and l_suppkey = s""")
def auto_correct_two_keys(spark, sf_dir):
    """All key pairs count; a lookup as large as the source."""
    lines = table(spark, sf_dir, "lineitem")
    source = lines.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity",
        F.expr("case when l_orderkey % 5 = 0 then null else l_extendedprice end as price"),
    )
    lookup = lines.select(F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), "l_extendedprice")
    return auto_correct(source, lookup, {"l_partkey": "p", "l_suppkey": "s"}, {"price": "l_extendedprice"})


@query("auto_correct_two_fills", """SELECT c_custkey, c_nationkey, coalesce(case when c_custkey % 2 = 0 then null else c_name end, r.f.name) as c_name,
    coalesce(case when c_custkey % 3 = 0 then null else c_phone_code end, r.f.code) as code
    FROM (SELECT *, c_custkey % 7 as c_phone_code FROM customer) c
    LEFT JOIN (SELECT s_nationkey, min({'name': s_name, 'code': 1000 - s_suppkey}) as f FROM supplier GROUP BY 1) r ON c_nationkey = s_nationkey""")
def auto_correct_two_fills(spark, sf_dir):
    """Many lookup rows with one key: both columns are filled from the same row."""
    source = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_nationkey", "case when c_custkey % 2 = 0 then null else c_name end as c_name",
        "case when c_custkey % 3 = 0 then null else c_custkey % 7 end as code",
    )
    lookup = table(spark, sf_dir, "supplier").selectExpr("s_nationkey", "s_name", "1000 - s_suppkey as s_code")
    return auto_correct(source, lookup, {"c_nationkey": "s_nationkey"}, {"c_name": "s_name", "code": "s_code"})


@query("mask_alpha", r"SELECT c_custkey, regexp_replace(c_name, '\w', '*', 'g') as c_name, regexp_replace(c_mktsegment, '\w', '*', 'g') as c_mktsegment FROM customer")
def q_mask_alpha(spark, sf_dir):
    return mask_alpha(table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment", "c_acctbal"]).select("c_custkey", "c_name", "c_mktsegment")


@query("mask_alpha_unicode", r"SELECT doc_id, regexp_replace(text, '[\p{L}\p{N}_]', '$', 'g') as text FROM documents")
def mask_alpha_unicode(spark, sf_dir):
    """Letters of every script, with a mark that means something to the regex engine."""
    return mask_alpha(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"], "$")


@query("mask_date", r"SELECT o_orderkey, regexp_replace(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '\w', '0', 'g') as o_orderdate FROM orders")
def q_mask_date(spark, sf_dir):
    return mask_date(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate"])


@query("mask_numeric", "SELECT c_custkey, cast(null as double) as c_acctbal, cast(null as integer) as c_nationkey, c_name FROM customer")
def q_mask_numeric(spark, sf_dir):
    return mask_numeric(table(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"]).select("c_custkey", "c_acctbal", "c_nationkey", "c_name")


@query("mask_from_config", r"""SELECT o_orderkey, o_custkey, regexp_replace(o_orderstatus, '\w', 'X', 'g') as o_orderstatus, cast(null as double) as o_totalprice,
    regexp_replace(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '\w', '0', 'g') as o_orderdate, regexp_replace(o_orderpriority, '\w', 'X', 'g') as o_orderpriority FROM orders""")
def q_mask_from_config(spark, sf_dir):
    config = {"msk_alpha": "X,o_orderstatus,o_orderpriority", "msk_date": ",o_orderdate", "msk_numeric": "o_totalprice"}
    return mask_from_config(table(spark, sf_dir, "orders"), config)


def _check_key():
    """A key for these queries only; a task takes its key from the environment."""
    return key_from_hex("00112233445566778899aabbccddeeff")


@query("encrypt_roundtrip", "SELECT c_custkey, c_name, c_mktsegment, c_custkey % 17 <> 0 as differs FROM (SELECT c_custkey, c_name, case when c_custkey % 17 = 0 then null else c_mktsegment end as c_mktsegment FROM customer) c")
def encrypt_roundtrip(spark, sf_dir):
    df = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name", "case when c_custkey % 17 = 0 then null else c_mktsegment end as c_mktsegment")
    hidden = encrypt_columns(df, ["c_name", "c_mktsegment"], _check_key()).withColumn("cipher", F.col("c_mktsegment"))
    shown = decrypt_columns(hidden, ["c_name", "c_mktsegment"], _check_key())
    return shown.select("c_custkey", "c_name", "c_mktsegment", F.coalesce(F.col("cipher") != F.col("c_mktsegment"), F.lit(False)).alias("differs"))


@query("encrypt_random_nonce", "SELECT c_custkey, c_name FROM customer")
def encrypt_random_nonce(spark, sf_dir):
    hidden = encrypt_columns(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_name"], _check_key(), joinable=False)
    return decrypt_columns(hidden, ["c_name"], _check_key())


@query("encrypt_join_stable", """SELECT c_mktsegment, count(*) as orders, count(distinct o_custkey) as customers FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def encrypt_join_stable(spark, sf_dir):
    """Equal values keep equal ciphertexts, so encrypted keys still join."""
    key, nonce = _check_key(), derived_key(_check_key(), "nonce")
    # Count per key before anything else: a hot customer is encrypted once and crosses the join as one row.
    per_key = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    # Not null by construction: a null test inferred from the join would encrypt every scanned row.
    hidden = {c: F.coalesce(encrypt(c, key, nonce), F.lit("")).alias("k") for c in ("o_custkey", "c_custkey")}
    per_key = per_key.select(hidden["o_custkey"], "n")
    customers = table(spark, sf_dir, "customer").select(hidden["c_custkey"], "c_mktsegment")
    return per_key.join(customers, "k").groupBy("c_mktsegment").agg(F.sum("n").alias("orders"), F.count(F.lit(1)).alias("customers"))


@query("features_chain", rf"""SELECT c_custkey, regexp_replace(c_name, '\w', '#', 'g') as c_name, c_mktsegment, nation_name FROM ({_LEFT_SQL}) x""")
def features_chain(spark, sf_dir):
    """Auto-correct, then mask, then encrypt; read back with decrypt."""
    features = {
        "dq_auto_correction_required": "Y", "dq_lkup_key_column": {"c_nationkey": "n_nationkey"}, "dq_auto_correct_columns": {"nation_name": "n_name"},
        "data_masking_required": "Y", "data_masking_columns": {"msk_alpha": "#,c_name"},
        "data_encryption_required": "Y", "data_encryption_columns": "c_mktsegment,nation_name",
    }
    out = apply_features(GAPPY.frame(spark, sf_dir), features, _lookup(spark, sf_dir), _check_key())
    back = {"data_decryption_required": "Y", "data_decryption_columns": "c_mktsegment,nation_name"}
    return apply_features(out, back, key=_check_key()).select("c_custkey", "c_name", "c_mktsegment", "nation_name")


@query("proj_select", "SELECT l_orderkey, l_quantity FROM lineitem")
def proj_select(spark, sf_dir):
    return project(table(spark, sf_dir, "lineitem"), "l_orderkey, l_quantity")


@query("proj_alias", "SELECT l_orderkey as order_id, l_quantity as quantity FROM lineitem")
def proj_alias(spark, sf_dir):
    return project(table(spark, sf_dir, "lineitem"), "l_orderkey,l_quantity", "order_id,quantity")


@query("nan_to_null", "SELECT o_orderkey, case when o_orderkey % 13 = 0 then null else o_totalprice end as o_totalprice FROM orders")
def q_nan_to_null(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "case when o_orderkey % 13 = 0 then double('NaN') else o_totalprice end as o_totalprice")
    return nan_to_null(df)


@query("add_audit_columns", """SELECT *, 'loader' as "CRTD_BY", '2024-03-05 06:07:08' as "CRTD_DTTM", ' ' as "UPDT_BY", ' ' as "UPDT_DTTM" FROM orders""")
def q_add_audit_columns(spark, sf_dir):
    return add_audit_columns(table(spark, sf_dir, "orders"), "loader", F.lit("2024-03-05 06:07:08").cast("timestamp_ntz"))


@query("row_index", """SELECT o_orderkey, o_orderdate, row_number() over (order by o_orderdate, o_orderkey) - 1 as "index" FROM orders""")
def q_row_index(spark, sf_dir):
    return row_index(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])


@query("row_index_hot_key", """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
    row_number() over (order by l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 as "index" FROM lineitem""")
def row_index_hot_key(spark, sf_dir):
    """The leading order column has three values: buckets are cut inside each of them."""
    df = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return row_index(df, ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])


@query("union_sources", "SELECT c_name as name, c_nationkey as nationkey, c_acctbal as acctbal FROM customer UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier")
def union_sources(spark, sf_dir):
    """Chunks of one load put together by name."""
    parts = [project(table(spark, sf_dir, t), [f"{p}_name", f"{p}_nationkey", f"{p}_acctbal"], ["name", "nationkey", "acctbal"])
             for t, p in (("customer", "c"), ("supplier", "s"))]
    return parts[0].unionByName(parts[1])


@query("update_where", """SELECT o_orderkey, case when o_totalprice > 200000 then 'BIG' else o_orderstatus end as o_orderstatus,
    case when o_totalprice > 200000 then o_totalprice / 2 else o_totalprice end as o_totalprice FROM orders""")
def q_update_where(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return update_where(df, {"o_orderstatus": "'BIG'", "o_totalprice": "o_totalprice / 2"}, "o_totalprice > 200000")


@query("delete_where", "SELECT * FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 100000)")
def q_delete_where(spark, sf_dir):
    return delete_where(table(spark, sf_dir, "orders"), "o_orderstatus = 'F' AND o_totalprice < 100000")
