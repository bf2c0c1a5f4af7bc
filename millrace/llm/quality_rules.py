"""Quality rules by distribution divergence, in DataFrame expressions only.

A document is compared to its language. Two histograms are taken from every
text, of character classes and of the language's common words; the references
are the same histograms summed over all documents of a language. A document is
rejected if its Jensen-Shannon distance (base 2, 0 to 1) to the reference is
above the limit of the histogram. Short texts have noisy histograms: the common
words alone reject only above a minimum length, and so do the classes; below
theirs the common words must speak against the text as well, by more than the
sampling noise of its length. A token with digits (card, address, key, e-mail)
counts as one digit among the classes, so personal data, which a later step
masks, is no reason to reject. Accented and other wide letters count as letters:
their share tells the language, and texts in two languages are no junk.

Counted rules come first: too few words, or too many words in 3-word windows
that the text repeats.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WS_CHARS, WS_CLASS
from millrace.session import stage

# Frequent function words of the languages, as whole lower-case words.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "that", "is", "for"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se"),
}
# Lower-case letters (with all beyond ASCII) and white space, most of a text; the other
# classes are counted in what is left.
_PLAIN = r"[a-z\x80-\x{10FFFF}\x20\x09-\x0D]+"
_CLASSES = {
    "upper": "[^A-Z]+",
    "digit": "[^0-9]+",
    "punctuation": r"""[^.,;:?'"()\-]+""",
    "bar": "[^|]+",
    "symbol": "[^#*$%&<>]+",
}
# Numbers, addresses, keys and the like, with the signs inside them; counted as one digit.
_IDENTIFIER = r"""(?<![A-Za-z0-9._@+="'\-])[A-Za-z._@+="'\-]*+[0-9][A-Za-z0-9._@+="'\-]*+"""
_BINS = 2 + len(_CLASSES) + 1  # white space, plain letters, these, the rest
_FEW = 64  # repeated windows found by scanning a list; more are found by sorting
MAX_LANGUAGES = 10_000  # references up to this number are broadcast


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WS_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS_CLASS + "+"))


def repeated_words(words: Column, window: int = 3) -> Column:
    """Words covered by windows that the text has twice or more, windows by 64-bit hash."""

    def positions(h: Column) -> Column:
        def again(s: Column) -> Column:
            return F.array_distinct(F.filter(s, lambda x, i: F.get(s, i - 1) == x))

        def places(found: Column) -> Column:
            few = F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(found, x), i)), lambda i: i.isNotNull())
            return F.when(F.size(found) == 0, F.array().cast("array<int>")).when(F.size(found) <= _FEW, few).otherwise(
                let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), by_sort)
            )

        return let(let(F.sort_array(h), again), places)

    def by_sort(s: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            same = [F.get(s, i + k).getField("h").eqNullSafe(x.getField("h")) for k in (-1, 1)]
            return same[0] | same[1]

        return F.sort_array(F.transform(F.filter(s, again), lambda x: x.getField("i")))

    def covered(acc: Column, at: Column) -> Column:
        end = at + window
        add = F.least(F.lit(window), end - acc.getField("end"))
        return F.struct(end.alias("end"), (acc.getField("n") + add).alias("n"))

    firsts = F.slice(words, 1, F.greatest(F.size(words) - (window - 1), F.lit(0)))
    hashes = F.transform(firsts, lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, window))))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(let(hashes, positions), zero, covered, lambda acc: acc.getField("n"))


def _only(text: Column, others: str) -> Column:
    return F.char_length(F.regexp_replace(text, others, ""))


def _measures(text: Column, lang: Column, common: Mapping[str, Sequence[str]], repeats: bool) -> Column:
    """All measures of a text as one struct, so the text is cut into words once."""
    k = max((len(v) for v in common.values()), default=0)

    def word(i: int) -> Column:
        out = F.lit(None).cast("string")
        for code, found in common.items():
            if i < len(found):
                out = F.when(lang == code, found[i]).otherwise(out)
        return out

    def occurrences(spaced: Column, i: int) -> Column:
        own = F.concat(F.lit(" "), word(i), F.lit(" "))
        return (F.octet_length(spaced) - F.octet_length(F.replace(spaced, own, F.lit("")))) / F.octet_length(own)

    def classes(chars: Column, counted: Column, rest: Column) -> Column:
        spaces = F.char_length(text) - chars
        counts = F.array(*(_only(rest, p) for p in _CLASSES.values()))
        return let(counts, lambda c: F.concat(
            F.array(spaces, F.char_length(counted) - spaces - F.char_length(rest)),
            c, F.array(F.char_length(rest) - F.aggregate(c, F.lit(0), lambda s, x: s + x)),
        ))

    def of(w: Column) -> Column:
        n = F.size(w).cast("double")
        # Two blanks between words: occurrences of a word with a blank on each side don't overlap.
        hits = let(F.concat(F.lit(" "), F.lower(F.array_join(w, "  ")), F.lit(" ")), lambda t: F.array(*(occurrences(t, i) for i in range(k))))
        fields = [
            F.size(w).cast("bigint").alias("n_words"),
            let(F.char_length(F.array_join(w, "")), lambda chars: F.struct(
                chars.cast("bigint").alias("word_chars"),
                let(F.regexp_replace(text, _IDENTIFIER, "0"), lambda counted: let(
                    F.regexp_replace(counted, _PLAIN, ""), lambda rest: classes(chars, counted, rest)
                )).alias("classes"),
            )).alias("c"),
            # The last bin is all other words; a language without a list has no such histogram.
            let(hits, lambda h: F.concat(h, F.array(n - F.aggregate(h, F.lit(0.0), lambda s, x: s + x)))).alias("common"),
        ]
        if repeats:
            fields.append(repeated_words(w).cast("bigint").alias("n_repeat_words"))
        return F.struct(*fields)

    return let(words_of(text), of)


def _js(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two count arrays; NULL if either is empty."""

    def share(a: Column) -> Column:
        return let(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), lambda t: F.transform(a, lambda x: x / t))

    def part(x: Column, y: Column) -> Column:
        def half(v):
            return F.when(v > 0, v / 2 * F.log2(2 * v / (x + y))).otherwise(F.lit(0.0))

        return half(x) + half(y)

    total = F.aggregate(F.zip_with(share(p), share(q), part), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def measure(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common: Mapping[str, Sequence[str]] = COMMON_WORDS, prefix: str = "rule_"
) -> DataFrame:
    """``docs`` with counts and histograms: ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``classes``, ``common``, ``lang``."""
    text, lang = _text_and_lang(text_col, lang_col)

    def blank(line: Column) -> Column:
        return F.btrim(line, F.lit(WS_CHARS)) == ""

    lines = F.filter(F.split(text, "\n"), lambda x: ~blank(x))
    m = F.col(f"{prefix}m")
    return docs.withColumn(f"{prefix}m", _measures(text, lang, common, repeats=True)).withColumns({
        f"{prefix}n_words": m["n_words"],
        f"{prefix}word_chars": m["c"]["word_chars"],
        f"{prefix}n_symbols": (m["c"]["classes"][2 + list(_CLASSES).index("bar")] + m["c"]["classes"][2 + list(_CLASSES).index("symbol")]).cast("bigint"),
        f"{prefix}n_dup_lines": let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")),
        f"{prefix}n_repeat_words": m["n_repeat_words"],
        f"{prefix}classes": m["c"]["classes"],
        f"{prefix}common": m["common"],
        f"{prefix}lang": lang,
    }).drop(f"{prefix}m")


def _text_and_lang(text_col: str, lang_col: str) -> tuple[Column, Column]:
    return tuple(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text_col, lang_col))


def histograms(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common: Mapping[str, Sequence[str]] = COMMON_WORDS, prefix: str = "rule_") -> DataFrame:
    """Only what ``references`` needs of ``measure``."""
    text, lang = _text_and_lang(text_col, lang_col)
    own = docs.select(_measures(text, lang, common, repeats=False).alias("m"), lang.alias(f"{prefix}lang"))
    return own.select(f"{prefix}lang", F.col("m.c.classes").alias(f"{prefix}classes"), F.col("m.common").alias(f"{prefix}common"))


def references(measured: DataFrame, common: Mapping[str, Sequence[str]] = COMMON_WORDS, prefix: str = "rule_") -> DataFrame:
    """(ref_lang, ref_classes, ref_common): histograms summed over all documents of a language.

    Written to the shared folder; broadcast later if its size is small.
    """
    bins = {"classes": _BINS, "common": max((len(v) for v in common.values()), default=0) + 1}
    sums = measured.groupBy(F.col(f"{prefix}lang").alias(f"{prefix}ref_lang")).agg(
        *(F.sum(F.get(prefix + x, F.lit(i)).cast("double")).alias(f"{x}{i}") for x, n in bins.items() for i in range(n))
    )
    refs = stage(
        sums.select(f"{prefix}ref_lang", *(F.array(*(f"{x}{i}" for i in range(n))).alias(f"{prefix}ref_{x}") for x, n in bins.items())),
        "references",
    )
    return F.broadcast(refs) if refs.limit(MAX_LANGUAGES + 1).count() <= MAX_LANGUAGES else refs


def judge(
    measured: DataFrame,
    refs: DataFrame,
    min_words: int = 50,
    max_repeated: float = 0.5,
    class_limit: float = 0.19,
    class_min_words: int = 100,
    common_limit: float = 0.22,
    common_min_words: int = 100,
    common_noise: float = 1.2,
    prefix: str = "rule_",
) -> DataFrame:
    """``measured`` with ``class_distance``, ``common_distance``, ``base_failed``, ``kept``,
    without its histograms.

    A NULL or empty text has no words and fails. A NULL language is one of its
    own; a language without common words is compared by character classes alone.
    Below ``class_min_words`` a text far by its classes is kept if its common words
    are nearer than ``common_noise / sqrt(n_words)``, about the median distance of
    clean texts of that length. ``class_distance`` is NULL below ``min_words``, where
    all texts fail anyway, ``common_distance`` below ``common_min_words``.
    """
    p = prefix
    n = F.col(f"{p}n_words")
    listed = (F.size(f"{p}common") > 1) & F.get(f"{p}common", F.lit(0)).isNotNull()  # else there are no common words to speak for the text
    usual = listed & (F.col(f"{p}near") <= F.lit(common_noise) / F.sqrt(n))
    classes_far = (F.col(f"{p}class_distance") > class_limit) & ((n >= class_min_words) | ~F.coalesce(usual, F.lit(False)))
    far = classes_far | (F.col(f"{p}common_distance") > common_limit)
    return (
        measured.join(refs, F.col(f"{p}lang") == F.col(f"{p}ref_lang"), "left")
        .withColumns({
            f"{p}class_distance": F.when(n >= min_words, _js(F.col(f"{p}classes"), F.col(f"{p}ref_classes"))),
            f"{p}near": F.when(n >= min_words, _js(F.col(f"{p}common"), F.col(f"{p}ref_common"))),
            f"{p}base_failed": (n < min_words) | (F.col(f"{p}n_repeat_words") > n * max_repeated),
        })
        .withColumn(f"{p}common_distance", F.when(n >= common_min_words, F.col(f"{p}near")))
        .withColumn(f"{p}kept", ~F.col(f"{p}base_failed") & ~F.coalesce(far, F.lit(False)))
        .drop(*(p + x for x in ("classes", "common", "near", "lang", "ref_lang", "ref_classes", "ref_common")))
    )
