"""Access, claims, complaint and fraud queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from agentlake.core import table
from agentlake.functions import scalars as fn
from agentlake.operators import access as acc
from agentlake.operators import claims as op
from agentlake.operators import predicates as pred
from agentlake.operators import tfidf
from agentlake.plans import derive
from agentlake.plans.derive import CLAIMS_SQL, COMPLAINTS_SQL, PATIENTS_SQL, PATTERNS_SQL, TEXT_CLAIMS_SQL
from agentlake.plans.registry import query


def allowed_sql(who: str, level: str) -> str:
    return (
        f"({who} = 'admin' OR {who} = {level} OR {level} = 'public' OR ({who} = 'financial' AND {level} = 'agent')"
        f" OR ({who} = 'agent' AND {level} = 'customer'))"
    )


READERS_SQL = "(SELECT unnest(['public', 'customer', 'agent', 'financial', 'admin']) AS requester)"


def each_requester(df):
    """One copy of the row per requester level: five fixed values exploded in the row, no join."""
    return df.withColumn("requester", F.explode(F.array(*[F.lit(x) for x in acc.LEVELS])))


@query(
    "p11_row_access",
    f"""WITH {CLAIMS_SQL} SELECT requester, privacy_level, count(*) AS n FROM claims, {READERS_SQL}
    WHERE {allowed_sql('requester', 'privacy_level')} GROUP BY 1, 2""",
)
def row_access(spark, sf):
    counts = derive.claims(spark, sf).groupBy("privacy_level").agg(F.count("*").alias("n"))
    return acc.readable(each_requester(counts), F.col("requester")).select("requester", "privacy_level", "n")


@query(
    "p12_masked_claims",
    f"""WITH {CLAIMS_SQL} SELECT claim_id, status, CASE WHEN {allowed_sql("'agent'", 'privacy_level')} THEN code END AS code,
    CASE WHEN {allowed_sql("'agent'", 'privacy_level')} THEN amount_cents END AS amount_cents, patient_id AS history_key FROM claims""",
)
def masked_claims(spark, sf):
    rows = derive.claims(spark, sf).withColumn("history_key", F.col("patient_id"))
    out = acc.masked(rows, "agent", ["code", "amount_cents"], history=["history_key"])
    return out.select("claim_id", "status", "code", "amount_cents", "history_key")


@query(
    "p10_match_attributes",
    f"""WITH {CLAIMS_SQL} SELECT claim_id, patient_id FROM claims
    WHERE code = 'SMALL' AND status = 'pending' AND {allowed_sql("'agent'", 'privacy_level')}""",
)
def match_attributes(spark, sf):
    rows = acc.readable(derive.claims(spark, sf), "agent")
    return pred.match_attributes(rows, {"code": "SMALL", "colour": "red", "status": "pending"}).select("claim_id", "patient_id")


@query(
    "p18_extract_record_ids",
    """SELECT event_id, 'CLM-' || lpad(CAST(event_id AS VARCHAR), 6, '0') AS claim_id,
       CASE WHEN event_type = 'error' THEN 'CMPL-' || lpad(CAST(user_id % 10000 AS VARCHAR), 4, '0') ELSE '' END AS complaint_id FROM events""",
)
def extract_record_ids(spark, sf):
    from agentlake.functions.text import extract_id

    msg = F.concat(
        F.lit("About claim CLM-"), F.lpad(F.col("event_id").cast("string"), 6, "0"), F.lit(", see "),
        F.when(F.col("event_type") == "error", F.concat(F.lit("CMPL-"), F.lpad((F.col("user_id") % 10000).cast("string"), 4, "0"))).otherwise("no file"),
    )
    return table(spark, sf, "events").select(
        "event_id", extract_id(msg, "CLM", 6).alias("claim_id"), extract_id(msg, "CMPL", 4).alias("complaint_id")
    )


@query(
    "j5_patient_claims",
    f"""WITH {CLAIMS_SQL}, {PATIENTS_SQL} SELECT claim_id, patient_id, status FROM claims
    WHERE {allowed_sql("'agent'", 'privacy_level')}
      AND patient_id IN (SELECT patient_id FROM patients WHERE {allowed_sql("'agent'", 'privacy_level')})""",
)
def patient_claims(spark, sf):
    out = acc.patient_claims(derive.patients(spark, sf), derive.claims(spark, sf), "agent")
    return out.select("claim_id", "patient_id", "status")


@query(
    "j6_complaint_history",
    f"""WITH {COMPLAINTS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY seq) AS rn FROM complaint_log)
    SELECT claim_id, (rn - 1) // 50 AS page, count(*) AS n, string_agg(CAST(seq AS VARCHAR) || ':' || text, '|' ORDER BY seq) AS history
    FROM n GROUP BY 1, 2""",
)
def complaint_history(spark, sf):
    out = op.complaint_history(derive.complaint_log(spark, sf), "claim_id", "seq", "text", page_rows=50)
    text = F.transform("history", lambda h: F.concat(h["at"].cast("string"), F.lit(":"), h["text"]))
    return out.select("claim_id", "page", "n", F.array_join(text, "|").alias("history"))


@query(
    "x4_complaint_lifecycle",
    f"""WITH {COMPLAINTS_SQL}
    SELECT complaint_id, CASE arg_max(action, seq) WHEN 'resolve' THEN 'resolved' WHEN 'respond' THEN 'in_progress' ELSE 'open' END AS status,
      count(*) FILTER (action = 'respond') AS n_responses, arg_max(text, seq) FILTER (action = 'resolve') AS resolution,
      min(seq) AS created_at, max(seq) AS updated_at FROM complaint_log GROUP BY complaint_id""",
)
def complaint_lifecycle(spark, sf):
    return op.complaint_state(derive.complaint_log(spark, sf), "complaint_id", "seq")


@query(
    "v7_similar_claims",
    f"""WITH {CLAIMS_SQL},
    h AS (SELECT code, amount_cents, count(*) AS n FROM claims GROUP BY 1, 2),
    ho AS (SELECT code, patient_id, amount_cents, count(*) AS n FROM claims GROUP BY 1, 2, 3),
    na AS (SELECT code, amount_cents, sum(n) OVER (PARTITION BY code ORDER BY amount_cents RANGE BETWEEN 4999 PRECEDING AND 4999 FOLLOWING) AS c FROM h),
    oc AS (SELECT code, patient_id, amount_cents,
      sum(n) OVER (PARTITION BY code, patient_id ORDER BY amount_cents RANGE BETWEEN 4999 PRECEDING AND 4999 FOLLOWING) AS near,
      sum(n) OVER (PARTITION BY code, patient_id ORDER BY amount_cents RANGE BETWEEN 9999 PRECEDING AND 9999 FOLLOWING) AS wide FROM ho)
    SELECT claim_id, CAST(near - 1 AS BIGINT) AS n_same_patient, CAST(c - near AS BIGINT) AS n_other_patient,
           CAST(wide - near AS BIGINT) AS n_same_patient_close
    FROM claims JOIN na USING (code, amount_cents) JOIN oc USING (code, patient_id, amount_cents)""",
)
def similar_claims(spark, sf):
    return op.similar_claim_counts(derive.claims(spark, sf))


@query(
    "v7_similar_claims_list",
    f"""WITH {CLAIMS_SQL}, q AS (SELECT * FROM claims WHERE CAST(split_part(claim_id, '-', 2) AS BIGINT) % 50 = 0 AND amount_cents > 0),
    s AS (SELECT q.claim_id AS asked_id, c.claim_id,
            5 + CASE WHEN abs(c.amount_cents - q.amount_cents) < 5000 THEN 3 WHEN abs(c.amount_cents - q.amount_cents) < 10000 THEN 1 ELSE 0 END
              + CASE WHEN c.patient_id = q.patient_id THEN 1 ELSE 0 END AS tenths
          FROM q JOIN claims c ON c.code = q.code AND c.claim_id <> q.claim_id WHERE c.privacy_level IN ('public', 'customer', 'agent'))
    SELECT asked_id, claim_id, CAST(tenths / 10 AS DOUBLE) AS similarity_score,
           row_number() OVER (PARTITION BY asked_id ORDER BY tenths DESC, claim_id) AS place FROM s WHERE tenths >= 7""",
)
def similar_claims_list(spark, sf):
    """Asked are the claims of every fiftieth order; the asking agent reads public, customer and agent rows."""
    claims = derive.claims(spark, sf)
    return op.similar_claims_list(claims.filter(F.split("claim_id", "-")[1].cast("long") % 50 == 0), claims, "agent")


@query(
    "v13_fraud_rules",
    f"""WITH {CLAIMS_SQL}, c AS (SELECT *, count(*) OVER (PARTITION BY patient_id, code) AS n FROM claims)
    SELECT claim_id, 'high_amount' AS rule, CAST(0.6 AS DOUBLE) AS confidence FROM c WHERE amount_cents > 40000
    UNION ALL SELECT claim_id, 'repeat_procedure', CAST(0.7 AS DOUBLE) FROM c WHERE n - 1 >= 2""",
)
def fraud_rules(spark, sf):
    return op.fraud_rules(derive.claims(spark, sf))


@query(
    "a14_claims_per_patient",
    f"""WITH {CLAIMS_SQL} SELECT patient_id, count(*) AS n_claims,
    patient_id = (SELECT patient_id FROM claims GROUP BY 1 ORDER BY count(*) DESC, patient_id LIMIT 1) AS busiest FROM claims GROUP BY 1""",
)
def claims_per_patient(spark, sf):
    rows = derive.claims(spark, sf)
    top = op.busiest_patient(rows).select("patient_id", F.lit(True).alias("busiest"))
    out = op.claims_per_patient(rows).join(top, "patient_id", "left")
    return out.withColumn("busiest", F.coalesce("busiest", F.lit(False)))


def tfidf_sql(docs: str, queries: str, fit: str) -> str:
    """CTEs of a TF-IDF match; ``docs`` (id, text) and ``queries`` (query_id, text) are CTE names; result ``sims``."""
    stop = ", ".join(f"'{w}'" for w in tfidf.STOP_WORDS)
    def counts(key, src):
        return (
            f"SELECT {key} AS id, term, count(*) AS tf FROM (SELECT {key}, unnest(regexp_extract_all(lower(text), '{tfidf.WORD}')) AS term"
            f" FROM {src}) WHERE term NOT IN ({stop}) GROUP BY 1, 2"
        )

    base = ("dt", docs) if fit == "docs" else ("qt", queries)
    return f"""dt AS ({counts('id', docs)}), qt AS ({counts('query_id', queries)}),
    idf AS (SELECT term, ln((1 + (SELECT count(*) FROM {base[1]})) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf FROM {base[0]} GROUP BY term),
    dw AS (SELECT id, term, tf * idf AS w FROM dt JOIN idf USING (term)), dn AS (SELECT id, sqrt(sum(w * w)) AS n FROM dw GROUP BY id),
    qw AS (SELECT id, term, tf * idf AS w FROM qt JOIN idf USING (term)), qn AS (SELECT id, sqrt(sum(w * w)) AS n FROM qw GROUP BY id),
    sims AS (SELECT qw.id AS query_id, dw.id AS id, round(sum(dw.w / dn.n * (qw.w / qn.n)), 6) AS score
             FROM dw JOIN qw USING (term) JOIN dn ON dn.id = dw.id JOIN qn ON qn.id = qw.id GROUP BY 1, 2)"""


def kb_hits(spark, sf, **kw):
    docs, asked = derive.text_claims(spark, sf), derive.patterns(spark, sf)
    return tfidf.search(docs.select("id", "text"), asked.select("query_id", "text"), threshold=0.15, **kw)


SEARCH_SQL = f"""WITH {TEXT_CLAIMS_SQL}, {PATTERNS_SQL}, {tfidf_sql('text_claims', 'patterns', 'docs')}
    SELECT query_id, id, score FROM sims JOIN text_claims USING (id) WHERE score >= 0.15 AND {allowed_sql("'agent'", 'privacy_level')}"""


@query("v5_tfidf_search", SEARCH_SQL)
def tfidf_search(spark, sf):
    levels = derive.text_claims(spark, sf).select("id", "privacy_level")
    return kb_hits(spark, sf).join(acc.readable(levels, "agent"), "id").select("query_id", "id", "score")


@query("v5_tfidf_search_many", SEARCH_SQL)
def tfidf_search_many(spark, sf):
    """As if the patterns had more words than can be carried: prefix filter."""
    levels = derive.text_claims(spark, sf).select("id", "privacy_level")
    return kb_hits(spark, sf, max_postings=100).join(acc.readable(levels, "agent"), "id").select("query_id", "id", "score")


@query(
    "v6_hybrid_claim_search",
    f"""WITH {TEXT_CLAIMS_SQL}, {PATTERNS_SQL}, {tfidf_sql('text_claims', 'patterns', 'docs')}
    SELECT s.query_id, s.id, round(least(1.0, score + CASE WHEN d.code = q.code THEN 0.2::DOUBLE ELSE 0 END
      + CASE WHEN q.amount > 0 AND abs(d.amount - q.amount) < 50 THEN 0.1::DOUBLE WHEN q.amount > 0 AND abs(d.amount - q.amount) < 100 THEN 0.05::DOUBLE ELSE 0 END
      + CASE WHEN d.patient = q.patient THEN 0.1::DOUBLE ELSE 0 END), 6) AS score
    FROM sims s JOIN text_claims d ON d.id = s.id JOIN patterns q ON q.query_id = s.query_id WHERE score >= 0.2""",
)
def hybrid_search(spark, sf):
    docs, asked = derive.text_claims(spark, sf), derive.patterns(spark, sf)
    hits = tfidf.search(docs.select("id", "text"), asked.select("query_id", "text"), threshold=0.2)
    return tfidf.boosted(hits, docs, asked)


def pattern_hits(spark, sf):
    docs = derive.text_claims(spark, sf).select("id", "text")
    asked = derive.patterns(spark, sf)
    hits = tfidf.search(docs, asked.select("query_id", "text"), threshold=0.1, fit_on="queries", strict=True)
    known = acc.readable(asked, "agent").select("query_id", "severity")
    return hits.join(known, "query_id").select(
        F.col("id").alias("claim_id"), F.col("query_id").alias("pattern_id"), "severity", F.col("score").alias("similarity_score")
    )


MATCHES_SQL = f"""{TEXT_CLAIMS_SQL}, {PATTERNS_SQL}, {tfidf_sql('text_claims', 'patterns', 'queries')},
    matches AS (SELECT id AS claim_id, query_id AS pattern_id, severity, score AS similarity_score FROM sims JOIN patterns USING (query_id)
                WHERE score > 0.1 AND {allowed_sql("'agent'", 'privacy_level')})"""
TOTALS_SQL = f"""{MATCHES_SQL},
    rules AS (SELECT id AS claim_id, CAST(0.6 AS DOUBLE) AS confidence FROM text_claims WHERE amount_cents > 40000
              UNION ALL SELECT id, CAST(0.7 AS DOUBLE) FROM (SELECT id, count(*) OVER (PARTITION BY patient, code) AS n FROM text_claims) WHERE n - 1 >= 2),
    totals AS (SELECT claim_id, sum(part) AS total FROM (
      SELECT claim_id, similarity_score * CASE severity WHEN 'low' THEN 0.3::DOUBLE WHEN 'medium' THEN 0.6::DOUBLE WHEN 'high' THEN 0.8::DOUBLE
             WHEN 'critical' THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS part FROM matches UNION ALL SELECT claim_id, confidence FROM rules) GROUP BY 1)"""


@query("v12_fraud_patterns", f"WITH {MATCHES_SQL} SELECT * FROM matches")
def fraud_patterns(spark, sf):
    return pattern_hits(spark, sf)


def _rule_rows(spark, sf):
    rows = derive.text_claims(spark, sf).select(F.col("id").alias("claim_id"), F.col("patient").alias("patient_id"), "code", "amount_cents")
    return rows, op.fraud_rules(rows)


@query("a18_fraud_totals", f"WITH {TOTALS_SQL} SELECT claim_id, round(total, 7) AS total FROM totals")
def fraud_totals(spark, sf):
    _, rules = _rule_rows(spark, sf)
    return op.fraud_totals(pattern_hits(spark, sf), rules).select("claim_id", F.round("total", 7).alias("total"))


@query(
    "v14_fraud_assessment",
    f"""WITH {TOTALS_SQL}, t AS (SELECT id AS claim_id, round(coalesce(total, 0), 7) AS total FROM text_claims LEFT JOIN totals ON claim_id = id),
    r AS (SELECT *, CASE WHEN total < 0.3 THEN 'low' WHEN total < 0.7 THEN 'medium' WHEN total < 1.2 THEN 'high' ELSE 'critical' END AS risk FROM t)
    SELECT claim_id, total, risk, CASE risk WHEN 'low' THEN 'Proceed with normal processing' WHEN 'medium' THEN 'Flag for manual review before approving'
      WHEN 'high' THEN 'Requires investigator review before processing' ELSE 'Suspend claim and initiate fraud investigation' END AS recommendation FROM r""",
)
def fraud_assessment(spark, sf):
    rows, rules = _rule_rows(spark, sf)
    return op.assess(rows, pattern_hits(spark, sf), rules)


@query(
    "f18_f19_risk_and_severity",
    f"""WITH {PATTERNS_SQL}, {CLAIMS_SQL}
    SELECT claim_id, CASE WHEN amount_cents / 50000.0 < 0.3 THEN 'low' WHEN amount_cents / 50000.0 < 0.7 THEN 'medium'
      WHEN amount_cents / 50000.0 < 1.2 THEN 'high' ELSE 'critical' END AS risk,
      CAST(CASE status WHEN 'approved' THEN 0.3 ELSE 0.5 END AS DOUBLE) AS weight FROM claims""",
)
def risk_and_severity(spark, sf):
    rows = derive.claims(spark, sf)
    sev = F.when(F.col("status") == "approved", "low").otherwise("unknown")
    return rows.select("claim_id", fn.risk_class(F.col("amount_cents") / 50000.0).alias("risk"), fn.severity_weight(sev).alias("weight"))
