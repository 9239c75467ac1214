"""Rule bitmask ledger: every quality rule is evaluated once, policies come after.

``measure`` turns a text into a few numbers, ``ledger`` stores them with one integer whose
bit i says that rule i failed. A policy is a mask over those bits, so that verdicts under any
version, and what leaving a rule out would change, are integer operations on the ledger and
need no text. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rule names in the order of their bits, each with a predicate over the measurements.
#: All compare whole numbers, so engines agree on them.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", "10 * n_symbols > 3 * n_words"),
    ("repeated_lines", "10 * n_dup_lines > 4 * n_lines"),
    ("short_words", "10 * word_chars < 25 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
)

#: Policy versions: names of the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": ("too_few_words", "repeated_windows", "many_symbols", "repeated_lines"),
    "v2": ("too_few_words", "repeated_windows", "many_symbols", "repeated_lines", "short_words", "long_words"),
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def bits(names: tuple[str, ...]) -> int:
    at = {name: i for i, (name, _) in enumerate(RULES)}
    return sum(1 << at[n] for n in names)


#: Word positions covered by 3-word windows that occur twice or more. ``w`` is the word list.
#: Windows are sorted by (hash, position); equal neighbours, compared as words, are repeats.
#: Each step is bound to a lambda variable, so that nothing is evaluated once per element.
_REPEATS = """
transform(array(sort_array(transform(sequence(0, size(w) - 3), i ->
    struct(xxhash64(w[i], w[i + 1], w[i + 2]) AS h, i AS i)))), s ->
  size(array_distinct(flatten(filter(transform(s, (x, k) ->
    CASE WHEN (get(s, k - 1).h = x.h AND w[get(s, k - 1).i] = w[x.i]
               AND w[get(s, k - 1).i + 1] = w[x.i + 1] AND w[get(s, k - 1).i + 2] = w[x.i + 2])
           OR (get(s, k + 1).h = x.h AND w[get(s, k + 1).i] = w[x.i]
               AND w[get(s, k + 1).i + 1] = w[x.i + 1] AND w[get(s, k + 1).i + 2] = w[x.i + 2])
         THEN array(x.i, x.i + 1, x.i + 2) END), p -> p IS NOT NULL)))))[0]
"""

_MEASURE = f"""
transform(array(array_remove(split(coalesce({{text}}, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), '')), w ->
  struct(
    CAST(size(w) AS BIGINT) AS n_words,
    CAST(length(array_join(w, '')) AS BIGINT) AS word_chars,
    CAST(CASE WHEN size(w) < 4 THEN 0 ELSE {_REPEATS} END AS BIGINT) AS n_repeat_words))[0]
"""

_LINES = r"""
transform(array(filter(split(coalesce({text}, ''), '\n'), l -> l RLIKE '[^\\x20\\x09-\\x0D]')), l ->
  struct(
    CAST(size(l) AS BIGINT) AS n_lines,
    CAST(size(l) - size(array_distinct(l)) AS BIGINT) AS n_dup_lines))[0]
"""


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``MEASURES`` (bigint) of every row.

    A null or empty text has zero everywhere; null keys and repeated rows stay; other columns
    are left out. Everything happens inside a row: no shuffle.
    """
    q = f"`{text}`"
    per = docs.select(
        F.col(key).alias(key),
        F.expr(_MEASURE.format(text=q)).alias("_w"),
        F.expr(_LINES.format(text=q)).alias("_l"),
        F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
    )
    return per.select(key, "_w.n_words", "_w.word_chars", "n_symbols", "_l.n_lines", "_l.n_dup_lines", "_w.n_repeat_words")


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Measurements and ``failed``: bit i is set where rule i fails."""
    failed = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, (_, rule) in enumerate(RULES))
    return measure(docs, key, text).withColumn("failed", F.expr(f"CAST({failed} AS BIGINT)"))


def passes(policy: str, failed: Column | None = None) -> Column:
    """True where no rule of the policy failed."""
    return (F.col("failed") if failed is None else failed).bitwiseAND(F.lit(bits(POLICIES[policy]))) == 0


def ablation(led: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: rows it fails, rows only it fails, and rows kept without it.

    One pass: rows are counted by their failure mask first (at most 2^rules groups, summed
    before the shuffle), the rest is arithmetic on those counts.
    """
    mask = bits(POLICIES[policy])
    by_mask = led.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    rules = [(name, 1 << i) for i, (name, _) in enumerate(RULES) if mask >> i & 1]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("bigint").alias("b")) for n, b in rules]))
    hit = F.col("m").bitwiseAND(F.col("r.b")) != 0
    return (
        by_mask.select("m", "n", each.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("fails"),
            F.sum(F.when(F.col("m") == F.col("r.b"), F.col("n")).otherwise(0)).alias("fails_alone"),
            F.sum(F.when(F.col("m").bitwiseAND(F.lit(mask).bitwiseXOR(F.col("r.b"))) == 0, F.col("n")).otherwise(0)).alias("kept_without"),
            F.sum("n").alias("rows"),
        )
    )
