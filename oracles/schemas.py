"""Driver table schemas as Spark reads them: (column, kind, Spark dtype)."""

N, S, T = "numeric", "string", "temporal"

SCHEMAS = {
    "region": [("r_regionkey", N, "int"), ("r_name", S, "string")],
    "nation": [("n_nationkey", N, "int"), ("n_name", S, "string"), ("n_regionkey", N, "int")],
    "customer": [("c_custkey", N, "bigint"), ("c_name", S, "string"),
                 ("c_nationkey", N, "int"), ("c_acctbal", N, "double"),
                 ("c_mktsegment", S, "string")],
    "supplier": [("s_suppkey", N, "bigint"), ("s_name", S, "string"),
                 ("s_nationkey", N, "int"), ("s_acctbal", N, "double")],
    "part": [("p_partkey", N, "bigint"), ("p_name", S, "string"), ("p_brand", S, "string"),
             ("p_type", S, "string"), ("p_size", N, "int"), ("p_retailprice", N, "double")],
    "orders": [("o_orderkey", N, "bigint"), ("o_custkey", N, "bigint"),
               ("o_orderstatus", S, "string"), ("o_totalprice", N, "double"),
               ("o_orderdate", T, "timestamp_ntz"), ("o_orderpriority", S, "string")],
    "lineitem": [("l_orderkey", N, "bigint"), ("l_partkey", N, "bigint"),
                 ("l_suppkey", N, "bigint"), ("l_linenumber", N, "int"),
                 ("l_quantity", N, "double"), ("l_extendedprice", N, "double"),
                 ("l_discount", N, "double"), ("l_tax", N, "double"),
                 ("l_returnflag", S, "string"), ("l_linestatus", S, "string"),
                 ("l_shipdate", T, "timestamp_ntz")],
    "events": [("event_id", N, "bigint"), ("ts", T, "timestamp_ntz"), ("user_id", N, "bigint"),
               ("event_type", S, "string"), ("value", N, "double"), ("props", S, "string")],
    "documents": [("doc_id", N, "bigint"), ("text", S, "string"), ("lang", S, "string"),
                  ("source", S, "string"), ("n_chars", N, "bigint")],
    "labels": [("doc_id", N, "bigint"), ("quality", N, "int"), ("toxic", N, "int")],
    "pages": [("page_id", N, "bigint"), ("url", S, "string"), ("html", S, "string")],
    "benchmark": [("item_id", N, "bigint"), ("text", S, "string")],
    "conversations": [("conv_id", N, "bigint"), ("turn", N, "bigint"), ("role", S, "string"),
                      ("text", S, "string")],
    "embeddings": [("vec_id", N, "bigint"), ("label", N, "int")],
}

# Columns of the dirty orders view (FIXTURES.md section 3).
DIRTY = [("o_orderkey", N, "bigint"), ("cust_num", N, "double"), ("sparse_num", N, "double"),
         ("total_price", N, "double"), ("status", S, "string"), ("urgent", S, "string"),
         ("order_date", S, "string"), ("num_text", S, "string")]
