"""Secret scans: spans of credentials, and weak parts that count only beside their complements. Column expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plenaria.llm.common import column, stored

#: Kinds in the order in which spans of one start are listed; the first three are reported wherever they are found.
KINDS = ["assign", "access", "hex", "key", "endpoint", "user"]
BASE = 3
#: Pattern, the group whose length counts, and its least length.
PATTERNS = {
    "assign": (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    # weak: 32 to 64 letters and digits of all kinds, as of secret keys, with their padding; only their own characters bound them
    "key": (r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{32,64}={0,2}(?![A-Za-z0-9+/])", 0, 32),
    # weak: addresses of services
    "endpoint": (r"https?://[A-Za-z0-9][A-Za-z0-9.:-]*[A-Za-z0-9](?:/[A-Za-z0-9._~/-]*)?", 0, 10),
    # weak: named account identifiers
    "user": (r"(?i:(user(?:name)?|login|account|client_id))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9_.@-]+)", 2, 3),
}
#: Parts belong together when they begin at most so many code points apart.
SCOPE = 400
IDENTIFIERS, SECRETS = ("access", "user"), ("assign", "hex", "key")


def spans(text: Column, kind: str) -> Column:
    """Array of (start, kind number, end) of the leftmost non-overlapping matches, in code points, end exclusive.

    The text between matches and the matches themselves alternate, so their lengths add up to the starts.
    """
    pattern, group, least = PATTERNS[kind]
    number = KINDS.index(kind)
    empty = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    matches, held = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    parts = F.zip_with(F.zip_with(F.split(text, pattern, -1), matches, lambda a, b: F.struct(F.length(a).alias("gap"), F.length(b).alias("size"))),
                       held, lambda a, b: F.struct(a.gap.alias("gap"), a["size"].alias("size"), F.length(b).alias("held")))

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + part["size"]
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        found = F.when(part["held"] >= least, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(F.coalesce(end, start).alias("at"), found.alias("found"))

    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("found")), add, lambda s: s["found"])
    return F.when(text.rlike(pattern), found).otherwise(empty)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> tuple[Column, Column, Column]:
    """Id, digest and whole text of a row; equal rows are scanned as one."""
    whole = F.coalesce(column(text).cast("string"), F.lit(""))
    return column(doc_id), F.xxhash64(whole, F.length(whole)), whole


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest, and the arrays base (strong spans) and weak of every row."""
    number, digest, whole = _keyed(docs, doc_id, text)
    rows = docs.select(number.alias("doc_id"), digest.alias("digest"), whole.alias("text"))
    found = {k: spans(F.col("text"), k) for k in KINDS}
    return rows.select("doc_id", "digest", F.array_sort(F.concat(*(found[k] for k in KINDS[:BASE]))).alias("base"),
                       F.array_sort(F.concat(*(found[k] for k in KINDS[BASE:]))).alias("weak"))


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row (doc_id, digest) with any the weak spans whose complements begin within the scope, as array linked.

    A key needs an identifier, an account identifier needs a secret, and an endpoint needs both. Parts are dealt into
    bins as wide as the scope. A weak part meets, of its own bin and the two beside it, only the first and last
    identifier and secret; these tell whether any is within the scope, so no pairs of parts are made.
    """
    parts = (found.where(F.size("weak") > 0).select("doc_id", "digest", F.explode(F.concat("base", "weak")).alias("span"))
             .select("doc_id", "digest", "span.*").distinct().withColumn("bin", F.expr(f"start div {scope}")))
    kinds = {name: [KINDS.index(k) for k in group] for name, group in (("identifier", IDENTIFIERS), ("secret", SECRETS))}
    ends = [end(F.when(F.col("kind").isin(group), F.col("start"))).alias(f"{side}_{name}")
            for name, group in kinds.items() for side, end in (("first", F.min), ("last", F.max))]
    anchors = parts.groupBy("doc_id", "digest", "bin").agg(*ends)
    weak = parts.where(F.col("kind") >= BASE).select("doc_id", "digest", "start", "kind", "end", F.explode(F.array(*(F.col("bin") + i for i in (-1, 0, 1)))).alias("bin"))
    a, b = weak.alias("a"), anchors.alias("b")
    met = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.digest") == F.col("b.digest")) & (F.col("a.bin") == F.col("b.bin")))
    near = {name: F.max(reduce(lambda x, y: x | y, (F.coalesce(F.abs(F.col(f"b.{side}_{name}") - F.col("a.start")) <= scope, F.lit(False)) for side in ("first", "last"))))
            for name in kinds}
    judged = met.groupBy("a.doc_id", "a.digest", "a.start", "a.kind", "a.end").agg(*(v.alias(k) for k, v in near.items()))
    needs = {"key": F.col("identifier"), "user": F.col("secret"), "endpoint": F.col("identifier") & F.col("secret")}
    kept = judged.where(reduce(lambda x, y: x | y, ((F.col("kind") == KINDS.index(k)) & need for k, need in needs.items())))
    return kept.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("linked"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """doc_id, digest, base (strong spans) and spans (those and the linked weak ones) of every row.

    A span is (start, number of its kind, end). Null text is empty and has no spans; a null doc_id is an id like any
    other; repeated rows come back as often. Empty table: empty result.
    """
    found = stored(scanned(docs, doc_id, text))
    more = linked(found, scope)
    a, b = found.alias("a"), more.alias("b")
    joined = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.digest") == F.col("b.digest")), "left")
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    return joined.select("a.doc_id", "a.digest", "a.base", F.array_sort(F.concat("a.base", F.coalesce("b.linked", none))).alias("spans"))


def count(found: str, kind: str) -> Column:
    """How many spans of a kind an array holds."""
    return F.size(F.filter(found, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def written(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def masked(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span, or run of overlapping spans, replaced by a mark."""
    def add(state: Column, span: Column) -> Column:
        inside = span["start"] < state["at"]
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.when(inside, state["out"]).otherwise(F.concat(state["out"], F.array(gap, F.lit(mark)))).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    return F.aggregate(found, start, add, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))))


def redacted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """The documents, all columns kept, with their secrets masked; texts without any, null ones too, are unchanged."""
    hits = scan(docs, doc_id, text, scope).where(F.size("spans") > 0).select("doc_id", "digest", "spans").dropDuplicates(["doc_id", "digest"])
    number, digest, whole = _keyed(docs, doc_id, text)
    rows = docs.select(F.struct(*(column(c) for c in docs.columns)).alias("row"), number.alias("number"), digest.alias("own"))
    joined = rows.join(hits, F.col("number").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("digest")), "left")
    new = F.when(F.col("spans").isNull(), F.col(f"row.`{text}`")).otherwise(masked(F.col(f"row.`{text}`"), F.col("spans")))
    return joined.select(F.struct(*((new if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns)).alias("row")).select("row.*")
