"""Quality rules: base statistics of a document, then distribution divergence.

A document's histogram of character classes and its histogram of common words are compared with
references of its language by Jensen-Shannon distance (base 2, 0 to 1). A document is rejected if both distances
are above their thresholds, or, if it is long enough for the words alone to tell, if their distance is above a
higher one. Guards: ``min_chars`` characters for the first rule, ``min_words`` words for the second.

References can't be moved by a source, a very long text or junk. English, French, German and Spanish (by the
first part of the language code, in any case) have shipped ones, rounded shares of usual prose, fixed,
so that no judged table moves them (written from memory, not counted in a cited corpus, and with the means of sf0.1 in view). Any other language gets the medians over its sources of the medians over each source's
documents' shares (documents of ``min_words`` words or more, each counted once whatever its length); then,
over the documents near that, the mean over sources of each source's mean. It needs ``min_sources`` sources and
``min_reference_words`` words; junk that holds most of most sources is beyond telling. Without a reference, and for a null language,
letters of any script and spaces count as one class and the word distance is that from the nearest
shipped one; the words alone then reject nothing.

One narrow pass over the texts; documents of languages that aren't shipped, if there are any, are read once more before, and
their shares stored. No text is shuffled. The references are one row a language; they are broadcast only
below ``MAX_BROADCAST_LANGUAGES``.

Defined results: null text counts as having no characters and no words, and fails the base; empty
tables give empty results; repeated rows are judged each; other columns are not looked at by
``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, WS_CLASS, cut, held, split_words, text_of, window_texts, with_window_hashes

SYMBOLS = r"[#*$%&|<>]"
CLASSES = ("lower", "upper", "space", "digit", "symbol", "shout", "other")
#: Very frequent words of English, French, German and Spanish.
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was",
    "de", "la", "le", "et", "les", "des", "un", "une", "en", "que",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "ein",
    "el", "y", "los", "se", "del", "las",
)
WINDOW = 8
MAX_BROADCAST_LANGUAGES = 20_000

#: Shares of character classes (as CLASSES, without the last, which is the rest) in usual prose.
SHIPPED_CHARS = {
    "en": (0.775, 0.030, 0.170, 0.005, 0.0, 0.001),
    "fr": (0.775, 0.025, 0.165, 0.005, 0.0, 0.001),
    "de": (0.765, 0.050, 0.145, 0.005, 0.0, 0.001),
    "es": (0.780, 0.025, 0.165, 0.005, 0.0, 0.001),
}
#: How often in a thousand running words each common word occurs in usual prose, rounded.
SHIPPED_WORDS = {
    "en": {"the": 60, "of": 32, "and": 28, "to": 26, "in": 21, "that": 11, "is": 10, "it": 10, "for": 9, "was": 9},
    "fr": {"de": 48, "la": 28, "le": 23, "et": 21, "les": 19, "des": 15, "en": 13, "un": 12, "une": 11, "que": 10, "se": 5},
    "de": {"der": 33, "die": 32, "und": 27, "in": 18, "den": 12, "das": 12, "zu": 11, "von": 10, "mit": 9, "ein": 7, "des": 6, "was": 1.5},
    "es": {"de": 56, "la": 36, "que": 29, "el": 28, "y": 26, "en": 25, "los": 16, "se": 11, "del": 11, "las": 10, "un": 10},
}


def shipped_reference(lang: str) -> tuple[list[float], list[float]]:
    """Shares of CLASSES and of COMMON_WORDS and the rest."""
    words = [SHIPPED_WORDS[lang].get(w, 0) / 1000 for w in COMMON_WORDS]
    return [*SHIPPED_CHARS[lang], 1 - sum(SHIPPED_CHARS[lang])], [*words, 1 - sum(words)]


def language_code(lang: str = "lang") -> Column:
    return F.lower(F.regexp_extract(lang, r"^\s*([^-_\s]*)", 1))


def histograms(docs: DataFrame) -> DataFrame:
    """Adds words (array), char_hist and word_hist (arrays of long) for a column ``body`` without nulls."""
    # what is left after lower-case letters is a fifth of usual prose, and a twentieth once its white space is gone too
    out = docs.withColumn("words", held(split_words(F.col("body")))).withColumn("rest", held(F.regexp_replace(F.regexp_replace("body", "[a-z]+", ""), r"\p{Ll}+", "")))
    out = out.withColumn("few", held(F.regexp_replace("rest", f"[{WS_CLASS}]+", "")))
    only = lambda keep: F.length(F.regexp_replace("few", f"[^{keep}]+", "")).cast("long")
    out = out.withColumn("n_space", (F.length("rest") - F.length("few")).cast("long")).withColumn("n_symbols", only(r"#*$%&|<>"))
    out = out.withColumn("n_upper", only(r"\p{Lu}")).withColumn("n_digit", only(r"\p{Nd}")).withColumn("n_shout", only("!?"))
    n_rest = F.length("rest").cast("long")
    out = out.withColumn(
        "char_hist",
        F.array(
            F.length("body").cast("long") - n_rest, F.col("n_upper"), F.col("n_space"), F.col("n_digit"), F.col("n_symbols"), F.col("n_shout"),
            n_rest - F.col("n_upper") - F.col("n_space") - F.col("n_digit") - F.col("n_symbols") - F.col("n_shout"),
        ),
    )
    # each hit stands between two spaces of its own, so that counting by removal finds all of them
    out = out.withColumn("hits", F.filter("words", lambda w: w.isin(*COMMON_WORDS)))
    out = out.withColumn("line", F.concat(F.lit(" "), F.array_join("hits", "  "), F.lit(" ")))
    counts = [
        ((F.length("line") - F.length(F.replace("line", F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)).cast("long") for w in COMMON_WORDS
    ]
    other = (F.size("words") - F.size("hits")).cast("long")
    return out.withColumn("word_hist", F.array(*counts, other)).drop("rest", "few", "n_upper", "n_digit", "n_shout", "hits", "line")


def _shares(hist: Column) -> Column:
    total = F.aggregate(hist, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(hist, lambda x: x / F.greatest(total, F.lit(1)))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two share arrays."""

    def term(a: Column, b: Column) -> Column:
        mid = (a + b) / 2
        part = lambda x: F.when(x > 0, x * F.log2(x / mid)).otherwise(F.lit(0.0))
        return (part(a) + part(b)) / 2

    total = F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(F.lit(0.0), total))


def own_references(
    docs: DataFrame, max_char_distance: float, max_word_distance: float, min_words: int, min_reference_words: int, min_sources: int
) -> DataFrame | None:
    """docs(lang, source, text) -> ref_lang, ref_chars, ref_words of the languages that aren't shipped; None if there are none."""
    other = docs.withColumn("code", language_code()).filter(F.col("code").isNotNull() & ~F.col("code").isin(*SHIPPED_WORDS))
    if not other.select("code").limit(1).count():
        return None
    h = histograms(other.select("code", F.col("source").cast("string").alias("source"), text_of().alias("body")))
    h = h.withColumn("n_words", F.size("words")).filter(F.col("n_words") >= min_words)
    stored = cut(h.select("code", "source", "n_words", F.concat(_shares(F.col("char_hist")), _shares(F.col("word_hist"))).alias("shares")))
    n, size = len(CLASSES), len(CLASSES) + len(COMMON_WORDS) + 1
    each = lambda f, column: F.array(*[f(F.get(column, F.lit(i))) for i in range(size)]).alias("shares")
    median = lambda x: F.percentile_approx(x, 0.5, 1000)
    chars, words = F.slice("shares", 1, n), F.slice("shares", n + 1, size - n)
    part = lambda x: F.transform(x, lambda v: v / F.aggregate(x, F.lit(0.0), lambda a, y: a + y))
    by_source = stored.groupBy("code", "source").agg(each(median, "shares"), F.sum("n_words").alias("n"))
    first = by_source.groupBy("code").agg(each(median, "shares"), F.sum("n").alias("n"), F.count("*").alias("sources"))
    first = first.filter((F.col("n") >= min_reference_words) & (F.col("sources") >= min_sources))
    first = cut(first.select(F.col("code").alias("ref_lang"), part(chars).alias("ref_chars"), part(words).alias("ref_words")))
    near = stored.join(F.broadcast(first) if first.count() <= MAX_BROADCAST_LANGUAGES else first, F.col("code") == F.col("ref_lang"))
    near = near.filter((js_distance(chars, F.col("ref_chars")) <= max_char_distance) & (js_distance(words, F.col("ref_words")) <= max_word_distance))
    second = near.groupBy("code", "source").agg(each(F.avg, "shares")).groupBy("code").agg(each(F.avg, "shares"))
    second = second.select("code", chars.alias("near_chars"), words.alias("near_words"))
    found = first.join(second, F.col("ref_lang") == F.col("code"), "left")
    return cut(found.select("ref_lang", F.coalesce("near_chars", "ref_chars").alias("ref_chars"), F.coalesce("near_words", "ref_words").alias("ref_words")))


def statistics(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_dup_lines, n_repeat_words (n_symbols is there) to ``histograms``."""
    out = histograms(docs)
    lines = F.filter(F.split("body", "\n"), lambda line: F.btrim(line, F.lit(WS_CHARS)) != "")
    out = with_window_hashes(out.withColumn("lines", lines), "words", WINDOW, "grams")
    repeats = F.size("grams") > F.size(F.array_distinct("grams"))
    # only texts whose window hashes repeat are looked at window by window, by the words themselves
    out = out.withColumn("windows", F.when(repeats, window_texts(F.col("words"), WINDOW)).otherwise(F.array().cast("array<string>")))
    order = F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    out = out.withColumn("ordered", F.array_sort(order))
    same = lambda i, j: F.coalesce(F.get("ordered", i)["w"] == F.get("ordered", j)["w"], F.lit(False))
    hit = F.filter("ordered", lambda x, i: (F.when(i > 0, same(i - 1, i)).otherwise(False)) | same(i, i + 1))
    out = out.withColumn("starts", F.array_sort(F.transform(hit, lambda x: x["i"])))
    # windows cover WINDOW words each; a window that starts within the one before adds the difference
    covered = F.aggregate(
        F.transform("starts", lambda s, k: F.when(k == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), s - F.get("starts", k - 1)))),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    return (
        out.withColumn("n_words", F.size("words").cast("long"))
        .withColumn("word_chars", F.length("body").cast("long") - F.col("n_space"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .withColumn("n_repeat_words", covered)
        .drop("lines", "grams", "windows", "ordered", "starts", "words", "n_space")
    )


def judge(
    docs: DataFrame,
    corpus: DataFrame | None = None,
    max_char_distance: float = 0.14,
    max_word_distance: float = 0.21,
    min_chars: int = 100,
    max_word_distance_alone: float = 0.24,
    min_words: int = 100,
    min_reference_words: int = 1000,
    min_sources: int = 3,
) -> DataFrame:
    """docs with columns text, lang and, if there is one, source -> docs without text, plus the statistics, char_distance,
    word_distance, base_failed and kept. corpus: where references that aren't shipped come from (default: docs)."""
    corpus = docs if corpus is None else corpus
    source = F.col("source") if "source" in corpus.columns else F.lit(None)
    own = own_references(corpus.select("lang", source.alias("source"), "text"), max_char_distance, max_word_distance_alone, min_words, min_reference_words, min_sources)
    shipped = {lang: shipped_reference(lang) for lang in SHIPPED_WORDS}
    refs = docs.sparkSession.createDataFrame([(k, *v) for k, v in shipped.items()], "ref_lang string, ref_chars array<double>, ref_words array<double>")
    if own is not None:
        refs = refs.unionByName(own)
    if own is None or own.count() <= MAX_BROADCAST_LANGUAGES:
        refs = F.broadcast(refs)
    fixed = lambda values: F.array(*map(F.lit, values))
    s = statistics(docs.withColumn("body", text_of()).withColumn("__code", language_code()).drop("text")).drop("body")
    s = s.join(refs, F.col("__code") == F.col("ref_lang"), "left")
    known = F.col("ref_lang").isNotNull()
    chars, words = _shares(F.col("char_hist")), _shares(F.col("word_hist"))
    at = lambda x, *names: sum((F.get(x, F.lit(CLASSES.index(c))) for c in names), F.lit(0.0))
    folded = lambda x: F.array(at(x, "lower", "upper", "space", "other"), at(x, "digit"), at(x, "symbol"), at(x, "shout"))
    usual = [sum(v[0][i] for v in shipped.values()) / len(shipped) for i in range(len(CLASSES))]
    nearest = F.least(*[js_distance(words, fixed(w)) for _, w in shipped.values()])
    s = s.withColumn("char_distance", F.when(known, js_distance(chars, F.col("ref_chars"))).otherwise(js_distance(folded(chars), folded(fixed(usual)))))
    s = s.withColumn("word_distance", F.when(known, js_distance(words, F.col("ref_words"))).otherwise(nearest))
    n_chars = F.aggregate("char_hist", F.lit(0).cast("long"), lambda a, x: a + x)
    odd = (n_chars >= min_chars) & (F.col("char_distance") > max_char_distance) & (F.col("word_distance") > max_word_distance)
    odd = odd | (known & (F.col("n_words") >= min_words) & (F.col("word_distance") > max_word_distance_alone))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return s.withColumn("base_failed", failed).withColumn("kept", held(~failed & ~odd)).drop("__code", "ref_lang", "ref_chars", "ref_words", "char_hist", "word_hist")


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs whose document is kept, with all columns of docs."""
    names = docs.columns
    packed = docs.select(F.struct(*names).alias("row"), F.col("text"), F.col("lang"))
    kept = judge(packed, corpus=docs.select(*[c for c in ("text", "lang", "source") if c in names]), **options).filter("kept")
    return kept.select(*[F.col("row")[n].alias(n) for n in names])


def quality_verdicts(documents: DataFrame) -> DataFrame:
    return judge(documents.select("doc_id", "text", "lang", *[c for c in ("source",) if c in documents.columns])).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"),
    )


def _list_sql(values) -> str:
    return "[" + ", ".join(f"CAST({v!r} AS DOUBLE)" for v in values) + "]"


def _distance_sql(p: str, q: str, n: int) -> str:
    part = lambda x: f"CASE WHEN {x}[i] > 0 THEN {x}[i] * log2({x}[i] / (({p}[i] + {q}[i]) / 2)) ELSE 0.0 END"
    return f"sqrt(greatest(0.0, list_sum(list_transform(range(1, {n + 1}), lambda i: ({part(p)} + {part(q)}) / 2))))"


def _by_lang(part: int) -> str:
    return "CASE code " + " ".join(f"WHEN '{lang}' THEN {_list_sql(shipped_reference(lang)[part])}" for lang in SHIPPED_WORDS) + " END"


def _count_sql(chars: str) -> str:
    return f"length(t) - length(regexp_replace(t, '{chars}+', '', 'g'))"


#: For tables whose languages are all shipped ones: references that a table tells of itself aren't expressed.
ORACLE = f"""
WITH d AS MATERIALIZED (SELECT doc_id, lower(regexp_extract(lang, '^\\s*([^-_\\s]*)', 1)) AS code, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(0, 8)) AS k FROM rep) GROUP BY doc_id),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
c AS (SELECT doc_id, code, len(w) AS n_words, length(t) AS n_chars, {_count_sql("[\\x20\\x09-\\x0D]")} AS n_space, {_count_sql("[#*$%&|<>]")} AS n_symbols, {_count_sql("\\p{Ll}")} AS n_lower, {_count_sql("\\p{Lu}")} AS n_upper,
  {_count_sql("\\p{Nd}")} AS n_digit, {_count_sql("[!?]")} AS n_shout, [{", ".join(f"len(list_filter(w, lambda x: x = '{w}'))" for w in COMMON_WORDS)}] AS common FROM d),
h AS (SELECT *, list_transform([n_lower, n_upper, n_space, n_digit, n_symbols, n_shout, n_chars - n_lower - n_upper - n_space - n_digit - n_symbols - n_shout], lambda x: x / CAST(greatest(n_chars, 1) AS DOUBLE)) AS p,
  list_transform(list_append(common, n_words - list_sum(common)), lambda x: x / CAST(greatest(n_words, 1) AS DOUBLE)) AS q, {_by_lang(0)} AS rp, {_by_lang(1)} AS rq FROM c),
j AS (SELECT *, {_distance_sql("p", "rp", len(CLASSES))} AS cd, {_distance_sql("q", "rq", len(COMMON_WORDS) + 1)} AS wd FROM h),
b AS (SELECT j.*, coalesce(dup.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, n_words < 20 OR 100 * coalesce(cov.n, 0) > 30 * n_words AS base_failed FROM j LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id))
SELECT doc_id, n_words, n_chars - n_space AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ((n_chars >= 100 AND cd > 0.14 AND wd > 0.21) OR (n_words >= 100 AND wd > 0.24)) AS kept, round(cd, 6) AS char_distance, round(wd, 6) AS word_distance FROM b
"""
