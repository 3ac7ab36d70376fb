"""Secret scans with corpus-wide ownership frequencies, in DataFrame expressions alone.

Candidates are found by three base patterns and a general one for opaque tokens.  Each candidate's
value is hashed, and the corpus says in how many repositories (here: documents) and by how many
owners (here: sources) the hash occurs.  A value that ``COPIED_OWNERS`` owners or more have is a widely
copied example; one that fewer have and that looks live (``looks_live``) is a credential of its
owner.  Spans of the base patterns always stay; an opaque token is added where it is such a
credential and overlaps no base span.

Positions come without a user-defined function: splitting a text by a pattern gives the gaps between
its matches, extracting gives the matches, and running sums of both lengths, over a text's exploded matches, give starts and ends in
code points; the work is linear in the matches of a text.  Texts without a pattern's key letters skip it.

Cases: a null text is an empty one; texts without candidates have empty spans; null owners count as
one owner; repeated rows count once for each doc_id and are reported each; null doc_ids are allowed; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barloom.llm.common import spread_join, table, written

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of 24 and more are the runs that pass
OPAQUE = r"[A-Za-z0-9+/_-]{32,}={0,2}"
KINDS = ("assign", "access", "hex", "opaque")
COPIED_OWNERS = 3


def _matches(kind: str, text: Column, pattern: str) -> Column:
    """Array of (order, gap, found) of all matches of a pattern: the code points between a match and the one before it, and the match."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern), F.lit(1), F.size(whole))
    return F.zip_with(gaps, whole, lambda g, m: F.struct(F.lit(KINDS.index(kind)).alias("order"), F.length(g).alias("gap"), m.alias("found")))


def looks_live(value: Column) -> Column:
    """Letters and digits, at least eight different characters, no word that marks an example."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (different >= 8) & ~F.lower(value).rlike("example|sample|changeme|dummy|placeholder|xxxx|12345")


_EMPTY = "array<struct<order:int,gap:int,found:string>>"
_SPANS = "array<struct<start:bigint,order:int,kind:string,end:bigint,value:string,repositories:bigint,owners:bigint,verdict:string>>"


def _texts(docs: DataFrame, owner: str) -> DataFrame:
    """doc_id, of_text (a hash of the text), owner, row and matches of each document, as a table."""
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"))
    text, none = F.col("text"), F.array().cast(_EMPTY)
    lists = [
        F.when(text.rlike(r"(?i)(?:pass|secret|token|api_?key)[a-z]*[\"']?\x20*[:=]"), _matches("assign", text, ASSIGN)).otherwise(none),
        F.when(text.contains("AKIA"), _matches("access", text, ACCESS)).otherwise(none),
        F.when(text.rlike(HEX), _matches("hex", text, HEX)).otherwise(none),
        F.when(text.rlike(OPAQUE), _matches("opaque", text, OPAQUE)).otherwise(none),
    ]
    return written(docs.select("doc_id", F.xxhash64("text").alias("of_text"), "owner", F.monotonically_increasing_id().alias("row"), F.concat(*lists).alias("matches")), "secret-texts")


def _candidates(texts: DataFrame) -> DataFrame:
    """A row for each match that counts: doc_id, owner, row, order, kind, start, end, value and its hash, as a table.  Ends are running sums over a text's matches of a kind."""
    rows = texts.where(F.size("matches") > 0).select("doc_id", "owner", "row", F.posexplode("matches").alias("i", "m")).select("doc_id", "owner", "row", "i", "m.*").repartition("row")
    so_far = Window.partitionBy("row", "order").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    found, order, value = F.col("found"), F.col("order"), F.col("value")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length(found)).over(so_far)).withColumn("start", F.col("end") - F.length(found))
    rows = rows.withColumn("value", F.when(order == 0, F.regexp_extract(found, ASSIGN, 2)).otherwise(found))
    long = F.length(value)
    good = F.when(order == 0, long >= 6).when(order == 1, long >= 20).when(order == 2, long >= 24).otherwise(looks_live(value))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), order + 1)
    return written(rows.where(good).select("doc_id", "owner", "row", "order", kind.alias("kind"), "start", "end", "value", F.sha2("value", 256).alias("hash")), "secret-candidates")


def scan(docs: DataFrame, owner: str = "source") -> DataFrame:
    """doc_id, row, of_text and spans: structs of start, order, kind, end, value, repositories, owners, verdict
    (``copied``: widely copied example, ``owned``: owner-specific and live-looking, ``plain``: neither).

    ``row`` tells repeated rows of the result apart; ``of_text`` is xxhash64 of the text.
    """
    texts = _texts(docs, owner)
    rows = _candidates(texts)
    # Salted: a value that a third of all documents hold is counted in many tasks first.
    per_owner = rows.groupBy("hash", "owner", F.pmod(F.xxhash64("doc_id"), F.lit(64)).alias("salt")).agg(F.count_distinct("doc_id").alias("n"), F.count("*").alias("uses"))
    per_owner = per_owner.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses"))
    known = written(per_owner.groupBy("hash").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners"), F.sum("uses").alias("uses")), "secret-values")
    total = known.agg(F.sum("uses")).first()[0] or 0
    verdict = F.when(F.col("owners") >= COPIED_OWNERS, "copied").when(looks_live(F.col("value")), "owned").otherwise("plain")
    judged = spread_join(rows, known, ["hash"], F.col("uses"), total).withColumn("verdict", verdict)
    # An opaque span overlaps a base span if, of those that start before its end, one reaches past its start.
    base = F.col("order") < len(KINDS) - 1
    before = Window.partitionBy("row").orderBy(F.when(base, F.col("start")).otherwise(F.col("end")), base).rowsBetween(Window.unboundedPreceding, 0)
    reach = F.coalesce(F.max(F.when(base, F.col("end"))).over(before), F.lit(0))
    kept = judged.repartition("row").withColumn("reach", reach).where(base | ((F.col("verdict") == "owned") & (F.col("reach") <= F.col("start"))))
    span = F.struct("start", "order", "kind", "end", "value", "repositories", "owners", "verdict")
    spans = kept.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))  # one text's spans
    return texts.select("doc_id", "row", "of_text").join(spans, "row", "left").select("doc_id", "row", "of_text", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def digest(scanned: DataFrame) -> DataFrame:
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    owned = F.size(F.filter(spans, lambda x: x["verdict"] == "owned")).cast("long").alias("n_owned")
    copied = F.size(F.filter(spans, lambda x: x["verdict"] == "copied")).cast("long").alias("n_copied")
    return scanned.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(_joined(F.filter(spans, lambda x: x["order"] < 3)), 256).alias("base_sha256"), _joined(spans).alias("spans"), owned, copied)


def redacted(docs: DataFrame, owner: str = "source") -> DataFrame:
    """The documents with every owner-specific, live-looking secret replaced by ``[SECRET]``.

    Values are replaced by text, longest first, so a secret goes wherever it stands in its document.  Documents find their secrets by doc_id
    and text, so rows without a doc_id, or with one in common, have their own.
    """
    names = docs.columns
    scanned = scan(docs, owner).select("doc_id", "of_text", F.filter("spans", lambda x: x["verdict"] == "owned").alias("spans")).where(F.size("spans") > 0)
    values = scanned.select("doc_id", "of_text", F.explode("spans.value").alias("value")).distinct().groupBy("doc_id", "of_text").agg(F.collect_set("value").alias("values"))
    longest = F.reverse(F.array_sort(F.transform("values", lambda v: F.struct(F.length(v).alias("n"), v.alias("value")))))
    values = values.select(F.col("doc_id").alias("__secret_of"), F.col("of_text").alias("__secret_text"), longest.alias("__secret_values"))
    of_text = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    joined = docs.join(values, (of_text == values["__secret_text"]) & docs["doc_id"].cast("long").eqNullSafe(values["__secret_of"]), "left")
    none = F.col("__secret_values").isNull()
    clean = F.when(none, F.col("text")).otherwise(F.aggregate("__secret_values", F.col("text"), lambda t, v: F.replace(t, v["value"], F.lit("[SECRET]"))))
    out = joined.withColumn("text", clean)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(none, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*names)


def op8(spark: SparkSession, folder: str) -> DataFrame:
    return digest(scan(table(spark, folder, "documents")))


def _oracle() -> str:
    patterns = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, OPAQUE)))
    quoted = {k: p.replace("'", "''") for k, p in patterns.items()}
    live = "(regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND len(list_distinct(regexp_extract_all(value, '.'))) >= 8 AND NOT regexp_matches(lower(value), 'example|sample|changeme|dummy|placeholder|xxxx|12345'))"
    good = {"assign": "length(value) >= 6", "access": "length(value) >= 20", "hex": "length(value) >= 24", "opaque": live}
    parts = []
    for order, (kind, p) in enumerate(quoted.items()):
        value = f"regexp_extract(found, '{p}', 2)" if kind == "assign" else "found"
        parts.append(f"""SELECT doc_id, owner, {order} AS ord, '{kind}' AS kind, z - length(found) AS a, z AS e, value FROM (
  SELECT *, {value} AS value FROM (SELECT doc_id, owner, found, sum(length(gap) + length(found)) OVER (PARTITION BY doc_id ORDER BY i) AS z FROM (
    SELECT doc_id, owner, i, all_gaps[i] AS gap, all_found[i] AS found FROM (SELECT doc_id, owner, string_split_regex(t, '{p}') AS all_gaps, regexp_extract_all(t, '{p}', 0) AS all_found, unnest(range(1, len(regexp_extract_all(t, '{p}', 0)) + 1)) AS i FROM docs)))) WHERE {good[kind]}""")
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner FROM documents),
found AS ({' UNION ALL '.join(parts)}),
judged AS (SELECT f.*, CASE WHEN owners >= {COPIED_OWNERS} THEN 'copied' WHEN {live.replace('value', 'f.value')} THEN 'owned' ELSE 'plain' END AS verdict FROM found f JOIN (SELECT value, count(DISTINCT owner) AS owners FROM found GROUP BY value) o ON o.value = f.value),
kept AS (SELECT * FROM judged j WHERE ord < 3 OR (verdict = 'owned' AND NOT EXISTS (SELECT 1 FROM judged b WHERE b.doc_id = j.doc_id AND b.ord < 3 AND b.a < j.e AND j.a < b.e)))
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY a, ord) FILTER (ord < 3), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY a, ord), '') AS spans,
  count(*) FILTER (verdict = 'owned') AS n_owned, count(*) FILTER (verdict = 'copied') AS n_copied
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id GROUP BY d.doc_id
"""


ORACLE = _oracle()
