"""Hand-computed answers on small fixtures."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from agentlake.functions import scalars as fn
from agentlake.functions import text as tx
from agentlake.operators import access, ledger, predicates

D = dt.date


@pytest.fixture(scope="module")
def small_ledger(spark):
    rows = [
        (1, None, "sales", None, Decimal("50000.00"), D(2025, 1, 1)),
        (2, "A", "stock_orders", 100, Decimal("10.00"), D(2025, 1, 1)),
        (3, "A", "sales", 30, Decimal("4.00"), D(2025, 1, 2)),
        (4, "B", "stock_orders", 5, Decimal("1.00"), D(2025, 1, 3)),
        (5, "B", "sales", 5, Decimal("2.00"), D(2025, 1, 3)),
    ]
    return spark.createDataFrame(rows, "txn_id long, item string, txn_type string, units long, price decimal(18,2), txn_date date")


def test_stock_cash_and_top_sellers(small_ledger):
    assert [tuple(r) for r in ledger.stock_snapshot(small_ledger, "2025-01-02").collect()] == [("A", 70)]
    assert ledger.stock_snapshot(small_ledger, "2025-01-03").count() == 1
    assert ledger.cash_balance(small_ledger, "2025-01-02").first()[0] == Decimal("49994.00")
    assert ledger.cash_balance(small_ledger, "2024-01-01").first()[0] == Decimal("0.00")
    assert ledger.stock_of(small_ledger, "nothing", "2025-01-02").first().asDict() == {"item": "nothing", "current_stock": 0}
    top = ledger.top_sellers(small_ledger, "2025-01-03").collect()
    assert (top[0]["item"], top[0]["total_revenue"]) == (None, Decimal("50000.00"))
    assert ledger.top_sellers(small_ledger, "2025-01-03", include_null_item=False).first()["item"] == "A"


def test_report_total(spark, small_ledger):
    inv = spark.createDataFrame([("A", "a", Decimal("0.10")), ("C", "c", Decimal("9.00"))], "item string, item_name string, unit_price decimal(18,2)")
    rep = ledger.financial_report(inv, small_ledger, "2025-01-02").first()
    assert rep["inventory_value"] == Decimal("7.00")
    assert rep["total_assets"] == rep["cash_balance"] + rep["inventory_value"]
    # total assets = seed cash + sum(sale price - units x unit price) over stocked items
    assert rep["top_sellers"][0]["item"] is None


def test_as_of_stock_same_day_counts(spark, small_ledger):
    lines = spark.createDataFrame([("A", D(2024, 12, 31)), ("A", D(2025, 1, 1)), ("A", D(2025, 1, 2)), ("Z", D(2025, 1, 2))], "item string, request_date date")
    got = {(r["item"], r["request_date"]): r["available"] for r in ledger.as_of_stock(lines, small_ledger).collect()}
    assert got == {("A", D(2024, 12, 31)): 0, ("A", D(2025, 1, 1)): 100, ("A", D(2025, 1, 2)): 70, ("Z", D(2025, 1, 2)): 0}


def test_lead_time_and_discounts(spark):
    q = spark.createDataFrame([(x,) for x in (10, 11, 100, 101, 1000, 1001)], "q int")
    day = F.lit("2025-04-01").cast("date")
    got = [r[0].isoformat() for r in q.select(fn.delivery_date(day, F.col("q"))).collect()]
    assert got == ["2025-04-01", "2025-04-02", "2025-04-02", "2025-04-05", "2025-04-05", "2025-04-08"]
    d = spark.createDataFrame([(x,) for x in (99, 100, 499, 500, 999, 1000)], "q int")
    assert [float(r[0]) for r in d.select(fn.discount_rate(F.col("q"))).collect()] == [0, 0.05, 0.05, 0.1, 0.1, 0.15]


def test_price_half_even(spark):
    row = spark.createDataFrame([(Decimal("0.05"), 500)], "p decimal(18,2), q long")
    parts = fn.price_parts(F.col("p"), F.col("q"), fn.discount_rate(F.col("q")))
    got = row.select(*[c.alias(n) for n, c in parts.items()]).first()
    assert tuple(got) == (Decimal("25.00"), Decimal("2.50"), Decimal("22.50"))
    edge = spark.createDataFrame([(Decimal("0.50"), 100)], "p decimal(18,2), q long")  # 50.00 x 0.05 = 2.50
    assert edge.select(fn.price_parts(F.col("p"), F.col("q"), fn.discount_rate(F.col("q")))["total"]).first()[0] == Decimal("47.50")


def test_reorder_status_and_message(spark):
    r = spark.createDataFrame([(60, 100, 50), (100, 100, 50)], "s long, m long, q long")
    assert [x[0] for x in r.select(fn.reorder_quantity(F.col("s"), F.col("m"), F.col("q"))).collect()] == [140, None]
    st = spark.createDataFrame([(1, "FULFILLED"), (1, "NOT_FULFILLED"), (2, "FULFILLED"), (2, "INVALID"), (3, None)], "k int, s string")
    got = dict(tuple(x) for x in st.groupBy("k").agg(fn.worst_status(F.col("s"))).collect())
    assert got == {1: "NOT_FULFILLED", 2: "INVALID", 3: "INVALID"}


def test_eta(spark):
    rows = spark.createDataFrame([(0, 1), (45, 1), (45, 2), (45, 3)], "v long, p int")
    assert [r[0] for r in rows.select(fn.eta_days(F.col("v"), F.col("p"))).collect()] == [2, 5, 3, 2]


def test_access_pairs(spark):
    pairs = [(a, b) for a in access.LEVELS for b in access.LEVELS]
    df = spark.createDataFrame(pairs, "who string, level string")
    got = {(r["who"], r["level"]) for r in df.filter(access.can_access(F.col("who"), F.col("level"))).collect()}
    want = {(a, a) for a in access.LEVELS} | {("admin", b) for b in access.LEVELS} | {(a, "public") for a in access.LEVELS}
    want |= {("financial", "agent"), ("agent", "customer")}
    assert got == want
    m = access.masked(df.withColumn("secret", F.lit(1)), F.col("who"), ["secret"], level="level")
    assert all((r["secret"] is not None) == ((r["who"], r["level"]) in want) for r in m.collect())


def test_where_language(spark):
    df = spark.createDataFrame([(1, "a", "x y"), (5, "b", "y"), (9, "a", None)], "n int, t string, text string")
    pick = lambda w: sorted(r["n"] for r in df.filter(predicates.compile_where(w, df.schema)).collect())
    assert pick({"t": "a"}) == [1, 9] and pick({"n": {"$gt": 1, "$lt": 9}}) == [5]
    assert pick({"$and": [{"t": {"$eq": "a"}}, {"n": {"$gt": 1}}]}) == [9] and pick(None) == [1, 5, 9]
    with pytest.raises(ValueError):
        predicates.compile_where({"zzz": 1}, df.schema)
    assert df.filter(predicates.compile_where_document({"$contains": "y"})).count() == 2


def test_keyword_flags_and_substring_profiles(spark):
    df = spark.createDataFrame([("fine",), ("Uncertain and DEBATED",), ("an error, uncertain",)], "t string")
    got = [r[0] for r in df.select(predicates.flag_keywords(F.col("t"), ["error", "uncertain", "debated"])).collect()]
    assert got == [[], ["uncertain", "debated"], ["error", "uncertain"]]
    who = spark.createDataFrame([(1, "wang"), (2, "Li"), (3, "q"), (4, "nobody"), (5, "")], "id int, name string")
    prof = spark.createDataFrame([("Wang Xiaoming", 1, "VIP"), ("Li Wang", 2, "Regular"), ("Ms. Qian", 3, "VIP")], "full string, o int, type string")
    out = predicates.match_substring(who, "name", prof, "full", "o", "type", "None")
    assert dict((r["id"], r["type"]) for r in out.collect()) == {1: "VIP", 2: "Regular", 3: "VIP", 4: "None", 5: "None"}


def test_text_functions(spark):
    df = spark.createDataFrame([("```json\n{\"a\": {\"b\": 1}}\n```",), ("no",)], "t string")
    assert [r[0] for r in df.select(tx.outer_object(F.col("t"))).collect()] == ['{"a": {"b": 1}}', ""]
    one = spark.range(1)
    check = lambda c: one.select(c).first()[0]
    assert check(tx.collapse_spaces(F.lit("  a \t b\n c  "))) == "a b\n c"
    assert check(tx.verdict(F.lit("NOT_FULLY_INCORPORATED"), ["FULLY_INCORPORATED"], ["NOT_FULLY_INCORPORATED"])) is False
    assert check(tx.template("[{a}] {b}", {"a": F.lit(1), "b": F.lit(None)})) == "[1] "
    assert check(tx.valid_json(F.lit('{"a": '))) is False and check(tx.valid_json(F.lit("[1]"))) is True


def test_chunks_cover_the_text(spark):
    body = "\n".join("line %d %s" % (i, "x" * (i * 7 % 90)) for i in range(200))
    docs = spark.createDataFrame([(1, body), (2, "short"), (3, "y" * 1300)], "id long, text string")
    rows = tx.chunk_text(docs, "id", "text", size=500, overlap=200).orderBy("id", "chunk_id").collect()
    for doc, clean in ((1, body), (2, "short"), (3, "y" * 1300)):
        mine = [r["text"] for r in rows if r["id"] == doc]
        assert all(len(t) <= 500 for t in mine)
        at, end = 0, 0
        for t in mine:  # every chunk starts inside the covered part and extends it
            at = clean.index(t, max(0, end - 200) if end else 0)
            assert at <= end
            end = max(end, at + len(t))
        assert end == len(clean)
    assert [r["chunk_size"] for r in rows if r["id"] == 2] == [5]
    few = tx.chunk_text(docs, "id", "text", 500, 200, max_chunks=2, strip=True)
    assert few.groupBy("id").count().agg(F.max("count")).first()[0] == 2


def test_bounded_chunks_are_counted(spark):
    docs = spark.createDataFrame([(1, "y" * 1300), (2, "short")], "id long, text string")
    counts = lambda bound: sorted(tuple(r) for r in tx.chunk_counts(docs, "id", "text", 500, 200, max_chunks=bound, strip=True).collect())
    assert counts(2) == [(1, 4, 2), (2, 1, 0)] and counts(None) == [(1, 4, 0), (2, 1, 0)]


def test_the_index_holds_all_chunks_of_a_long_text(spark, tmp_path):
    from agentlake.plans import load_all

    spark.createDataFrame([(1, "word " * 30_000), (2, "short")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    queries = load_all()[0]
    n = {r["doc_id"]: r["count"] for r in queries["v2_index"](spark, str(tmp_path)).groupBy("doc_id").count().collect()}
    assert n[1] > 80 and n[2] == 1
    found = {r["doc_id"]: (r["n_seen"], r["n_dropped"]) for r in queries["v2_bounded_index_counts"](spark, str(tmp_path)).collect()}
    assert found == {1: (n[1], n[1] - 80), 2: (1, 0)}
