"""Secret scans: patterns, and multipart credentials linked within a scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from titlemart.llm.tables import stored

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# what strong findings look like: (kind, pattern); short matches of the last two cannot hide longer ones
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
# parts that mean little alone
LOGIN = r"""(?i:user(?:name|_id)?|login|client_?id|account(?:_id)?|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}"""
WEAK_SECRET = r"(?<![A-Za-z0-9/+=_.-])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=_-])"
ENDPOINT = r"""(?i:https?|ftp|sftp|ssh|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[^\s"'<>|]+"""

KINDS = ("assign", "access", "hex", "login", "secret", "endpoint")  # by number, which orders equal starts
STRONG_ASSIGN, WEAK_ASSIGN = 12, 6  # characters of a value
SCOPE = 200  # code points between the starts of parts that belong together
ROLES = {"assign": "secret", "hex": "secret", "secret": "secret", "access": "id", "login": "id", "endpoint": "endpoint"}
NEEDS = {"login": ["secret"], "secret": ["id", "endpoint"], "endpoint": ["secret"]}  # any of these must be near

SPAN = "array<struct<start: int, kind: int, end: int>>"
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "login": LOGIN, "secret": WEAK_SECRET, "endpoint": ENDPOINT}


def _matches(kind: str) -> Column:
    """Of the matches in column ``kind``, in order: how far each begins behind the one before, its length, and that of its value."""
    between = F.split("text", PATTERNS[kind], -1)
    value = (lambda m: F.length(F.regexp_extract(m, ASSIGN, 1))) if kind == "assign" else (lambda m: F.lit(0))
    sizes = lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("len"), value(m).alias("value"))
    return F.when(F.size(kind) > 0, F.zip_with(F.slice(between, 1, F.size(kind)), F.col(kind), sizes))


def scan(docs: DataFrame) -> DataFrame:
    """``row, doc_id`` of every document, and its matches of each kind, stored: one pass over the texts."""
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts.select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(kind) for kind, p in PATTERNS.items()])
    return stored(found.select("row", "doc_id", *[_matches(kind).alias(kind) for kind in PATTERNS]), "secret-matches")


def found_spans(scanned: DataFrame) -> DataFrame:
    """``row, start, kind, end, base``: strong spans, and weak ones that lie in none of them.

    Starts are running sums over a text's matches of a kind, and a weak span lies in a strong one if the
    largest end among those that begin no later reaches its own; both are linear in the matches.
    """
    each = None
    for number, kind in enumerate(PATTERNS):
        own = scanned.where(F.col(kind).isNotNull()).select("row", F.lit(number).alias("of"), F.posexplode(kind).alias("i", "m"))
        each = own if each is None else each.unionByName(own)
    so_far = W.partitionBy("row", "of").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("m.gap") + F.col("m.len")).over(so_far).cast("int")
    placed = each.select("row", "of", "m.value", (end - F.col("m.len")).alias("start"), end.alias("end"))
    assigned = F.col("of") == KINDS.index("assign")
    base = F.when(assigned, F.col("value") >= STRONG_ASSIGN).otherwise(F.col("of") <= KINDS.index("hex"))
    kind = F.when(assigned & ~base, F.lit(KINDS.index("secret"))).otherwise(F.col("of"))
    spans = placed.where(~assigned | (F.col("value") >= WEAK_ASSIGN)).select("row", "start", kind.alias("kind"), "end", base.alias("base"))
    begun = W.partitionBy("row").orderBy("start", F.col("base").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(begun)
    return spans.withColumn("reach", reach).where(F.col("base") | F.col("reach").isNull() | (F.col("reach") < F.col("end"))).drop("reach").distinct()


def linked_parts(spans: DataFrame) -> DataFrame:
    """Weak spans of ``found_spans`` that have a complementary part within the scope.

    An interval join on blocks of SCOPE code points: a part is matched with its own block
    and the two beside it. Of each block and role only the first and last start
    enter, which is all that "some part is near" needs, so the join gives at most three rows
    per weak span and role, however many parts a text holds.
    """
    named = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    role = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    spans = spans.withColumn("name", named).withColumn("block", F.floor(F.col("start") / SCOPE)).withColumn("role", F.element_at(role, F.col("name")))
    present = spans.groupBy("row", "block", "role").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    needs = F.create_map(*[x for k, v in NEEDS.items() for x in (F.lit(k), F.array(*[F.lit(r) for r in v]))])
    asks = spans.where(~F.col("base")).select("row", "start", "kind", "end", F.col("block").alias("own"), F.explode(F.element_at(needs, F.col("name"))).alias("role"))
    asks = asks.withColumn("block", F.explode(F.sequence(F.col("own") - 1, F.col("own") + 1)))
    near = (F.col("block") == F.col("own")) | (F.abs(F.col("first") - F.col("start")) <= SCOPE) | (F.abs(F.col("last") - F.col("start")) <= SCOPE)
    return asks.join(present, ["row", "block", "role"]).where(near).select("row", "start", "kind", "end").distinct()


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans`` of every row of ``docs(doc_id, text)``: arrays of ``(start, kind, end)``.

    ``base`` holds the strong findings: values of 12 characters or more assigned to a
    secret's name, access ids and long hex runs. ``spans`` adds what is weak alone - logins,
    endpoints, short assigned values and 40-character keys - if a complementary part starts
    within 200 code points: a secret beside a login or an endpoint, a login or an endpoint
    beside a secret. Kinds are numbers into KINDS; arrays are sorted. NULL text is empty and
    gives empty arrays; rows that repeat are scanned each for itself. Work is linear in a text's length and
    findings; only numbers are shuffled, never texts.
    """
    scanned = scan(docs)
    spans = stored(found_spans(scanned), "secret-spans")
    both = spans.where("base").select("row", "start", "kind", "end", "base").unionByName(linked_parts(spans).withColumn("base", F.lit(False)))
    span = F.struct("start", "kind", "end")
    arrays = both.groupBy("row").agg(F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"), F.sort_array(F.collect_list(span)).alias("spans"))
    none = F.array().cast(SPAN)
    return scanned.select("row", "doc_id").join(arrays, "row", "left").select("doc_id", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def span_text(spans: str) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
