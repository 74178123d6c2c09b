"""Quality rules by distribution divergence. DataFrame functions only.

A document's histograms, of classes of characters and of its language's common words, are compared with fixed language
references by Jensen-Shannon distance. A verdict depends on the document alone, never on other rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Classes of characters that are counted as patterns; lower-case a-z, white space and all others are three more.
UPPER, DIGITS, MARKS = "[A-Z]", "[0-9]", r"[.,;:!?'\x22()-]"
#: Common words of the languages, by frequency.
COMMON = {
    "en": "the of and to a in is that it for was on with as by be this are at from".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que pour est dans qui par sur pas au avec".split(),
    "es": "de la que el en y los se las del un por con no una su para al es lo".split(),
}
#: The share that the r-th common word has of all words, r from 1: Zipf's law with these constants (head, exponent).
ZIPF = (0.063, 0.82)
#: Shares of a-z, A-Z, digits, white space, marks, symbols and other characters (letters with accents) in
#: prose. They were counted over the documents of the sf0.1 tables that are labelled good, and rounded; "" stands for
#: any other language, whose letters are one class.
CLASSES = {
    "en": (0.795, 0.014, 0.001, 0.166, 0.024, 0.0, 0.0),
    "de": (0.772, 0.012, 0.001, 0.155, 0.022, 0.0, 0.038),
    "fr": (0.708, 0.010, 0.001, 0.167, 0.024, 0.0, 0.090),
    "es": (0.725, 0.012, 0.001, 0.161, 0.023, 0.0, 0.078),
    "": (0.809, 0.0, 0.001, 0.166, 0.024, 0.0, 0.0),
}
#: Histograms of fewer words or characters than these are coarse: the limits rise by the allowances times 1 / size less 1 / full size.
FULL_WORDS, FULL_CHARS, FOR_WORDS, FOR_CHARS = 100, 400, 3.0, 40.0
#: Distances (0 to 1) beyond which a document is not of its language's kind: of classes alone, or of classes and words together.
MOST_CLASS, MOST_BOTH = 0.30, (0.12, 0.30)


def references() -> dict[str, tuple[list[float], list[float]]]:
    """(classes, common words and all others) of each language."""
    head, power = ZIPF
    words = [head * r**-power for r in range(1, len(COMMON["en"]) + 1)]
    return {lang: (list(shares), [*words, 1 - sum(words)]) for lang, shares in CLASSES.items()}


def _repeats(w: Column) -> Column:
    """Words that lie in 5-word windows found twice or more. Windows are told apart by hash first; only a text in which two hashes agree compares them as text."""
    at = F.sequence(F.lit(0), F.size(w) - 5)
    hashes = lambda h: F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(5)]))
    windows = F.array_sort(F.transform(at, lambda i: F.struct(F.concat_ws(" ", *[F.get(w, i + k) for k in range(5)]).alias("g"), i.alias("i"))))

    def covered(s: Column) -> Column:
        same = lambda a, b: F.get(s, a)["g"] == F.get(s, b)["g"]
        twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)))
        places = F.array_sort(F.transform(twice, lambda j: F.get(s, j)["i"]))
        gaps = lambda p: F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b: F.least(F.lit(5), F.coalesce(b - a, F.lit(5))))
        return let(places, lambda p: F.aggregate(gaps(p), F.lit(0).cast("long"), lambda n, x: n + x))

    twice = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(hashes(h), lambda g: F.size(F.array_distinct(g)) < F.size(g)))
    return F.when(F.size(w) < 6, F.lit(0).cast("long")).when(twice, let(windows, covered)).otherwise(F.lit(0).cast("long"))


def _features(text: Column, lang: Column) -> Column:
    """Counts of a text, as a struct."""
    lists = F.when(F.lit(False), F.array(F.lit("")))
    for k, words in COMMON.items():
        lists = lists.when(lang == k, F.array(*map(F.lit, words)))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeats(w).alias("n_repeat_words"))

    def of_folded(w: Column) -> Column:
        """How often each common word of the language stands among the words without marks and case, and how many there are."""
        every = sorted({x for words in COMMON.values() for x in words})
        counts = let(F.filter(w, lambda x: x.isin(*every)), lambda f: F.transform(lists, lambda x: F.size(f) - F.size(F.array_remove(f, x))))
        return F.struct(F.size(w).cast("long").alias("n"), counts.alias("counts"))

    n_of = lambda s, kind: F.regexp_count(s, F.lit(kind)).cast("long")
    rest = lambda s: F.struct(F.length(s).cast("long").alias("n"), *[n_of(s, k).alias(name) for name, k in (("upper", UPPER), ("digits", DIGITS), ("marks", MARKS), ("symbols", SYMBOLS))])
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        F.length(text).cast("long").alias("n_chars"), let(F.array_remove(F.split(text, SPACE), ""), of_words).alias("w"),
        let(F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D.,;:!?'\x22()-]+"), ""), of_folded).alias("f"),
        let(F.regexp_replace(text, r"[a-z\x20\x09-\x0D]+", ""), rest).alias("c"),  # what is neither a-z nor white space is little
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
    )


def _js(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance: 0 for equal distributions, 1 for such that share nothing."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: let((a + b) / 2, lambda m: (part(a, m) + part(b, m)) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)))


def _allowance(size: Column, full: int, weight: float) -> Column:
    """What a limit rises by for a document of this size: nothing from the full size on."""
    return weight * F.greatest(F.lit(0.0), 1 / F.greatest(size, F.lit(1)) - 1 / full)


def quality_verdicts(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), text: str = "text", lang: str = "lang") -> DataFrame:
    """One row for each row of docs (doc_id, text, lang): the carried columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, js_class, js_word.

    base_failed: fewer than 10 words, or more than a fifth of them in repeated 5-word windows. Of the rest, a document
    is rejected if js_class exceeds MOST_CLASS, or both distances exceed MOST_BOTH. Below FULL_CHARS characters MOST_CLASS
    rises, below FULL_WORDS words the second of MOST_BOTH, since short histograms stray by chance. Common words are
    compared without case and marks. Other languages than those of COMMON, null too, have letters as one class, and no
    common words: js_word is null and js_class alone judges. Null text is empty: base_failed, distances null. Repeated
    rows are judged each; an empty table gives no rows; other columns are ignored. Nothing is shuffled. `text` and
    `lang` name the columns, or fields of a carried struct.
    """
    kind = F.lower(F.coalesce(F.col(lang), F.lit("")))
    own = docs.select(F.struct(*[F.col(c) for c in carry]).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("whole"), F.when(kind.isin(*COMMON), kind).otherwise(F.lit("")).alias("kind"))
    # one expression: a filter on the verdict, which Spark moves below, then computes the counts once as well
    judged = own.select("row", let(_features(F.col("whole"), F.col("kind")), lambda q: _verdict(q, F.col("kind"))).alias("v"))
    return judged.select("row.*", "v.*")


def _verdict(q: Column, kind: Column) -> Column:
    """What the counts of a text say of it, as a struct."""
    n, c, w = q["n_chars"], q["c"], q["w"]
    base_failed = (w["n_words"] < 10) | (100 * w["n_repeat_words"] > 20 * w["n_words"])
    space = n - w["word_chars"]
    lower, other = n - space - c["n"], c["n"] - c["upper"] - c["digits"] - c["marks"] - c["symbols"]
    known = kind != ""
    letters = F.when(known, lower).otherwise(lower + c["upper"] + other)
    none = F.lit(0).cast("long")
    counts = F.array(letters, F.when(known, c["upper"]).otherwise(none), c["digits"], space, c["marks"], c["symbols"], F.when(known, other).otherwise(none))
    classes = F.transform(counts, lambda x: x / F.greatest(n, F.lit(1)))
    shares = F.transform(q["f"]["counts"], lambda x: x / F.greatest(q["f"]["n"], F.lit(1)))
    words = let(shares, lambda s: F.concat(s, F.array(F.greatest(F.lit(0.0), 1 - F.aggregate(s, F.lit(0.0), lambda a, x: a + x)))))

    def reference(at: int) -> Column:
        out = F.when(F.lit(False), F.array(F.lit(0.0)))
        for k, held in references().items():
            if at == 0 or k:
                out = out.when(kind == k, F.array(*[F.lit(float(x)) for x in held[at]]))
        return out

    distances = F.struct(F.when(~base_failed, _js(classes, reference(0))).alias("js_class"), F.when(~base_failed & known, _js(words, reference(1))).alias("js_word"))

    def judge(d: Column) -> Column:
        class_far = d["js_class"] > MOST_CLASS + _allowance(n, FULL_CHARS, FOR_CHARS)
        both_far = (d["js_class"] > MOST_BOTH[0]) & (d["js_word"] > MOST_BOTH[1] + _allowance(w["n_words"], FULL_WORDS, FOR_WORDS))
        far = F.coalesce(class_far, F.lit(False)) | F.coalesce(both_far, F.lit(False))
        return F.struct(
            w["n_words"].alias("n_words"), w["word_chars"].alias("word_chars"), c["symbols"].alias("n_symbols"), q["n_dup_lines"].alias("n_dup_lines"), w["n_repeat_words"].alias("n_repeat_words"),
            base_failed.alias("base_failed"), (~base_failed & ~far).alias("kept"), d["js_class"].alias("js_class"), d["js_word"].alias("js_word"),
        )

    return let(distances, judge)
