"""Secret scans: strong patterns by themselves, weak ones by the company they keep.

Base kinds, leftmost and not overlapping within a kind (a match that is too short is dropped):
assign, access, hex. Weak kinds mean little alone: `key40` (40 base64 characters that no such
character, `_` or `-` continues; `=` may stand before them and a closing `.` after), `user` (an
assigned user or client name) and `endpoint` (an address with a scheme).
Parts are linked by an interval join within a scope of `scope` characters:

  key40     is reported if an identifier (access, user) starts within the scope;
  user      if a secret (assign, hex, key40) does;
  endpoint  if an identifier and a secret do.

A weak span that overlaps a base span of the document is left out. Base spans always stay.

One pass over the texts keeps only lengths of what lies in and between matches; positions are
running sums of these. The join's key is the document and the stretch of `scope` characters, so
a text with very many parts costs in proportion to its length. DataFrame functions only.

Nulls: a null text is empty; a null id stays null. Repeated rows have equal results. An empty
table gives an empty result, other columns are not read, texts are scanned whole. Positions are
code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.scratch import Scratch

SCOPE = 300

# Fixed values.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": (ASSIGN, 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
    "key40": (r"(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-]|\.[A-Za-z0-9+/_-])", 0, 40),
    "user": (r"""(?i)\b(?:user(?:name)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""", 0, 6),
    "endpoint": (r"""(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[^\s"'<>]+""", 0, 8),
}
#: What tells cheaply that a text has a match that counts.
HINTS = {"hex": r"[0-9a-f]{32}", "access": r"AKIA[A-Z0-9]{12}"}
BASE = ("assign", "access", "hex")
IDENTIFIERS = ("access", "user")
SECRETS = ("assign", "hex", "key40")


def _lengths(text: Column, pattern: str, group: int) -> Column:
    """Lengths before each match, of each match, and of what is measured of it."""
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    whole = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x))
    part = whole if not group else F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.length(x))
    return F.arrays_zip(F.slice(between, F.lit(1), F.size(whole)).alias("before"), whole.alias("length"), part.alias("part"))


def _scan(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    columns = []
    for kind, (pattern, group, _) in PATTERNS.items():
        found = F.when(text.rlike(HINTS.get(kind, pattern)), _lengths(text, pattern, group))
        columns.append(found.alias(kind))
    return documents.select(F.col(id_col).alias("doc_id"), F.xxhash64(text, F.length(text)).alias("text_hash"), *columns)


def _spans(scanned: DataFrame) -> DataFrame:
    """(doc_id, text_hash, rank, kind, start, end) of all matches that are long enough."""
    kinds = list(PATTERNS)
    some = F.coalesce(*(F.col(k).isNotNull().cast("int") for k in kinds))
    for k in kinds[1:]:
        some = F.greatest(some, F.col(k).isNotNull().cast("int"))
    texts = scanned.where(some == 1).dropDuplicates(["doc_id", "text_hash"])
    lists = F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(k).alias("kind"), F.col(k).alias("found")) for i, k in enumerate(kinds)))
    by_kind = texts.select("doc_id", "text_hash", F.explode(lists).alias("of")).select("doc_id", "text_hash", "of.*")
    matches = by_kind.where(F.col("found").isNotNull()).select(
        "doc_id", "text_hash", "rank", "kind", F.posexplode("found").alias("at", "match")
    )
    upto = Window.partitionBy("doc_id", "text_hash", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("match.before") + F.col("match.length")).over(upto)
    least = F.element_at(F.array(*(F.lit(PATTERNS[k][2]) for k in kinds)), F.col("rank") + 1)
    return matches.select(
        "doc_id", "text_hash", "rank", "kind", (end - F.col("match.length")).alias("start"), end.alias("end"),
        (F.col("match.part") >= least).alias("long_enough"),
    ).where("long_enough").drop("long_enough")


def _linked(spans: DataFrame, scope: int) -> DataFrame:
    """The weak spans that are reported."""
    own = ["doc_id", "text_hash"]
    weak = spans.where(~F.col("kind").isin(*BASE))
    stretch = F.floor(F.col("start") / scope)
    # Overlap with base spans: both are cut into stretches they touch.
    touched = F.explode(F.sequence(stretch, F.floor((F.col("end") - 1) / scope))).alias("stretch")
    base = spans.where(F.col("kind").isin(*BASE)).select(
        *(F.col(c).alias(f"b_{c}") for c in own), F.col("start").alias("b_start"), F.col("end").alias("b_end"), touched
    ).withColumnRenamed("stretch", "b_stretch")
    same = F.col("doc_id").eqNullSafe(F.col("b_doc_id")) & (F.col("text_hash") == F.col("b_text_hash"))
    clear = weak.select(*weak.columns, touched).join(
        base,
        same & (F.col("stretch") == F.col("b_stretch")) & (F.col("start") < F.col("b_end")) & (F.col("b_start") < F.col("end")),
        "left",
    )
    clear = clear.groupBy(*weak.columns).agg(F.count("b_start").alias("over")).where("over = 0").drop("over")
    parts = spans.where(F.col("kind").isin(*BASE)).union(clear)
    near = parts.where(F.col("kind").isin(*IDENTIFIERS, *SECRETS)).select(
        *(F.col(c).alias(f"b_{c}") for c in own),
        F.col("kind").isin(*IDENTIFIERS).alias("identifier"),
        F.col("start").alias("b_start"),
        F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("b_stretch"),
    )
    met = clear.withColumn("stretch", stretch).join(
        near, same & (F.col("stretch") == F.col("b_stretch")) & (F.abs(F.col("start") - F.col("b_start")) <= scope)
    )
    found = met.groupBy(*weak.columns).agg(
        F.max(F.col("identifier")).alias("identifier"), F.max(~F.col("identifier")).alias("secret")
    )
    wanted = (
        F.when(F.col("kind") == "key40", F.col("identifier"))
        .when(F.col("kind") == "user", F.col("secret"))
        .otherwise(F.col("identifier") & F.col("secret"))
    )
    return found.where(wanted).select(weak.columns)


def find_secrets(documents: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    scratch = Scratch(documents.sparkSession, "secrets")
    scanned = scratch.keep(_scan(documents, id_col, text_col), "scanned")
    spans = scratch.keep(_spans(scanned), "spans")
    reported = spans.where(F.col("kind").isin(*BASE)).union(_linked(spans, scope))
    text = F.concat_ws(":", "kind", "start", "end")
    found = reported.groupBy("doc_id", "text_hash").agg(
        *(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE),
        F.count(F.when(~F.col("kind").isin(*BASE), 1)).alias("n_linked"),
        F.array_sort(F.collect_list(F.struct("start", "rank", text.alias("said")))).alias("all"),
    )
    base = F.filter("all", lambda x: x["rank"] < len(BASE))
    joined = found.select(
        F.col("doc_id").alias("f_doc_id"), F.col("text_hash").alias("f_text_hash"), "n_assign", "n_access", "n_hex", "n_linked",
        F.array_join(base["said"], ",").alias("base"), F.array_join(F.col("all")["said"], ",").alias("spans"),
    )
    rows = scanned.select("doc_id", "text_hash").join(
        joined, F.col("doc_id").eqNullSafe(F.col("f_doc_id")) & (F.col("text_hash") == F.col("f_text_hash")), "left"
    )
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select(
        "doc_id", count("n_assign"), count("n_access"), count("n_hex"),
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        count("n_linked"),
    )
