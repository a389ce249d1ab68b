"""Quality rules: base counts, and divergence from the language's usual letters and words.

Every text is read once for its counts, a histogram over character classes and one over
its language's commonest words. The histograms of a language summed over all documents
are its reference. A text is dropped if its Jensen-Shannon distance (base 2) from the
reference is too large, for the words only beyond what a text of its length shows by
chance.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from urbanflux.llm.common import written_table

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Texts below these sizes are not judged by the histogram.
LEAST_CHARACTERS, LEAST_COUNTED_WORDS = 200, 50
#: Largest distance of the character classes, and of the words: base plus slack / sqrt(words).
MOST_CHARACTERS, WORDS_BASE, WORDS_SLACK = 0.35, 0.30, 0.5

# The commonest words of each language.
COMMON = {
    "en": "the of and to a in is that it for on was with as be this by are at from or an have not they which one you were her",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach",
    "fr": "de la le et les des en un du une que est pour qui dans sur au par pas avec ou ce il plus ne se sont son aux mais",
    "es": "de la que el en y los se las del un por con no una para su es al lo como más o pero sus le ha me si sin",
}
#: Other and unknown languages share one reference, over the words of all of them.
OTHER = ""
LISTS = {k: v.split() for k, v in COMMON.items()}
LISTS[OTHER] = list(dict.fromkeys(w for v in COMMON.values() for w in v.split()))
#: Characters beside blanks that end a word of the histogram.
MARKS = ".,;:!?\"'()"
SYMBOLS = "#*$%&|<>"
_PLACES = {k: {w.encode(): i for i, w in enumerate(v)} for k, v in LISTS.items()}
_BLANKS = b" \t\n\r\x0b\x0c"
_UNMARKED = bytes(32 if chr(b) in MARKS else b for b in range(256))


def _class(b: int) -> int:
    """Of a byte: lower, upper, digit, blank, mark, other ASCII, not ASCII; 7 for a byte that starts no character."""
    if 97 <= b <= 122:
        return 0
    if 65 <= b <= 90:
        return 1
    if 48 <= b <= 57:
        return 2
    if b in _BLANKS:
        return 3
    if b < 128:
        return 4 if chr(b) in MARKS else 5
    return 7 if b < 192 else 6


_CLASS = np.array([_class(b) for b in range(256)])
_IS_SYMBOL = np.array([b < 128 and chr(b) in SYMBOLS for b in range(256)])
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(text: str | None, lang: str | None) -> tuple:
    """The five counts and the two histograms of a text (null: empty)."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    per_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    classes = np.bincount(_CLASS, weights=per_byte, minlength=8)[:7].astype(np.int64)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) >= 3:
        numbers: dict[bytes, int] = {}
        n = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        size = len(numbers)
        pairs = np.unique(n[:-1] * size + n[1:], return_inverse=True)[1]
        _, place, count = np.unique(pairs[:-1] * size + n[2:], return_inverse=True, return_counts=True)
        again = count[place] > 1
        covered = np.zeros(len(words), bool)
        for shift in range(3):
            covered[shift : shift + len(again)] |= again
        repeated = int(covered.sum())
    places = _PLACES.get(lang, _PLACES[OTHER]) if lang is not None else _PLACES[OTHER]
    plain = text.lower().encode("utf-8", "replace").translate(_UNMARKED).split()
    histogram = np.bincount(np.fromiter((places.get(w, len(places)) for w in plain), np.int64, len(plain)), minlength=len(places) + 1)
    chars = int(classes.sum() - classes[3])
    return len(words), chars, int(per_byte[_IS_SYMBOL].sum()), len(lines) - len(set(lines)), repeated, classes.tolist(), histogram.tolist()


_MEASURED = StructType()
for _name in COUNTS:
    _MEASURED = _MEASURED.add(_name, LongType())
_MEASURED = _MEASURED.add("classes", ArrayType(LongType())).add("words", ArrayType(LongType()))


@F.pandas_udf(_MEASURED)
def _measured_column(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measured(t, g) for t, g in zip(texts, langs)], columns=[*COUNTS, "classes", "words"], index=texts.index)


def _distance(own: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms; 0 if either is empty."""

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    shares = F.zip_with(own, reference, lambda x, y: F.struct((x / total(own)).alias("x"), (y / total(reference)).alias("y")))
    parts = F.transform(shares, lambda s: part(s["x"], s["y"]) + part(s["y"], s["x"]))
    both = (total(own) > 0) & (total(reference) > 0)
    return F.when(both, F.sqrt(F.greatest(total(parts) / 2, F.lit(0.0)))).otherwise(0.0)


def _summed(histogram: str, size: int) -> Column:
    """Element-wise sum; places that no histogram of the group has are left out."""
    return F.filter(F.array(*[F.sum(F.get(histogram, F.lit(i))) for i in range(size)]), lambda x: x.isNotNull())


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the five counts, base_failed, kept, and the two distances of every row.

    A null text counts as empty: it fails for want of words. A null language and one
    without a word list are compared with the reference over all such rows. Repeated
    rows are judged alike, each on its own. An empty table gives an empty result. Other
    columns are not read. References have one row for each word list, so they are sent
    to every task.
    """
    listed = F.when(F.col("lang").isin([k for k in LISTS if k]), F.col("lang")).otherwise(OTHER)
    rows = docs.select("doc_id", listed.alias("_lang"), _measured_column.asNondeterministic()("text", "lang").alias("_m"))
    rows = written_table(rows.select("doc_id", "_lang", "_m.*"), "measured")
    reference = rows.groupBy("_lang").agg(
        _summed("classes", 7).alias("_classes"), _summed("words", max(len(v) for v in LISTS.values()) + 1).alias("_words"),
    )
    rows = rows.join(F.broadcast(written_table(reference, "references")), "_lang")
    percent = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    counted = F.aggregate("words", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.withColumns({
        "base_failed": (F.col("n_words") < LEAST_WORDS) | percent,
        "character_distance": _distance(F.col("classes"), F.col("_classes")),
        "word_distance": _distance(F.col("words"), F.col("_words")),
        "_counted": counted,
    })
    odd_characters = (F.col("word_chars") >= LEAST_CHARACTERS) & (F.col("character_distance") > MOST_CHARACTERS)
    limit = WORDS_BASE + WORDS_SLACK / F.sqrt(F.col("_counted"))
    odd_words = (F.col("_counted") >= LEAST_COUNTED_WORDS) & (F.col("word_distance") > limit)
    kept = ~F.col("base_failed") & ~odd_characters & ~odd_words
    return rows.withColumn("kept", kept).select("doc_id", *COUNTS, "base_failed", "kept", "character_distance", "word_distance")


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_CLASS_PATTERNS = ("[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", "[.,;:!?\"''()]", None, r"[^\x00-\x7F]")
_KNOWN = "[a-zA-Z0-9\\x20\\x09-\\x0D.,;:!?\"''()]|[^\\x00-\\x7F]"


def _class_count(pattern: str | None) -> str:
    if pattern is None:
        return f"len(text) - len(regexp_extract_all(text, '{_KNOWN}'))"
    return f"len(regexp_extract_all(text, '{pattern}'))"


RULES_SQL = rf"""
with texts as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
    case when lang in ({", ".join(f"'{k}'" for k in COMMON)}) then lang else '' end as list
  from documents
), split as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
    regexp_extract_all(lower(text), '[^\x20\x09-\x0D.,;:!?"''()]+') as plain,
    [{", ".join(_class_count(p) for p in _CLASS_PATTERNS)}] as classes
  from texts
), windows as (
  select r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as w from split, unnest(range(1, len(words) - 1)) as t(i)
), repeated as (
  select r, count(distinct p) as n_repeat_words from (
    select r, unnest([i, i + 1, i + 2]) as p from (select *, count(*) over (partition by r, w) as n from windows) where n > 1
  ) group by r
), lists as (
  select * from (values {", ".join(f"('{k}', {_sql_list(v)})" for k, v in LISTS.items())}) as t(list, common)
), counted as (
  select s.r, s.doc_id, s.list, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda x: len(x))), 0)::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words, classes, common, plain
  from split s join lists using (list) left join repeated using (r)
), slots as (
  select r, list, 'c' as kind, i, classes[i]::double as n from counted, unnest(range(1, 8)) as t(i)
  union all
  select r, list, 'w', coalesce(list_position(common, p), len(common) + 1), count(*)::double from counted, unnest(plain) as t(p) group by all
), reference as (
  select list, kind, i, sum(n) / sum(sum(n)) over (partition by list, kind) as y from slots group by list, kind, i
), own as (
  select r, list, kind, i, n / sum(n) over (partition by r, kind) as x, sum(n) over (partition by r, kind) as total from slots
), paired as (
  select o.r, o.kind, max(o.total) as total, sum(case when x > 0 then x * log2(2 * x / (x + y)) else 0 end
    + case when y > 0 then y * log2(2 * y / (x + y)) else 0 end) as inner_part, sum(y) as covered
  from own o join reference f using (list, kind, i) group by o.r, o.kind
), distances as (
  select r, kind, total, sqrt(greatest((inner_part + 1 - covered) / 2, 0)) as d from paired
), judged as (
  select c.*, coalesce(a.d, 0) as cd, coalesce(b.d, 0) as wd, coalesce(b.total, 0) as plain_words
  from counted c left join distances a on a.r = c.r and a.kind = 'c' left join distances b on b.r = c.r and b.kind = 'w'
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words as base_failed,
  not (n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words)
    and not (word_chars >= {LEAST_CHARACTERS} and cd > {MOST_CHARACTERS})
    and not (plain_words >= {LEAST_COUNTED_WORDS} and wd > {WORDS_BASE} + {WORDS_SLACK} / sqrt(plain_words)) as kept
from judged
"""
