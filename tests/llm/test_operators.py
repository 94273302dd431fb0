"""The ten operators on small fixtures: defined results of odd inputs, and brute force."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, normal
from veilframe.llm import (
    chat_format,
    common,
    decontaminate,
    license_scan,
    ngram_join,
    packing,
    quality_rules,
    queries,
    sharding,
    token_counts,
    toxicity,
    url_filter,
)

DOC = "doc_id long, text string, lang string, source string, n_chars long, body string, node long"


def docs(spark, rows):
    """Documents with extra columns of clashing names."""
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", 0, "x", 7) for i, t in rows], DOC)


ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (4, "one"), (None, "no id here at all"), (5, "word " * 30_000), (6, "a b c d e f g"), (7, "a b c d e f g"), (8, "ÀÉ ñandú <|endoftext|> \\### x")]


def small(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


# ---- SQL twins


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twin(spark, duck, name):
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    assert normal(got) == normal(duck.execute(queries.ORACLES[name]).df())


# ---- 1 chat formatting


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, msg_id long, role string, op string, text string")


def test_fold_deltas_edits_regenerations(spark):
    rows = [
        (1, 1, 1, "user", "message", "hi"), (1, 2, 2, "assistant", "start", None), (1, 3, 2, None, "delta", "he"), (1, 4, 2, None, "delta", "llo"),
        (1, 5, 1, None, "edit", "hi there"), (1, 6, 2, None, "regenerate", None), (1, 7, 2, None, "delta", "good "), (1, 8, 2, None, None, "day"),
        (1, 9, 3, "user", "message", "gone"), (1, 10, 3, None, "delete", None), (2, 1, 1, None, None, "x"), (None, 1, 1, "user", "message", None),
    ]
    got = {(r.conv_id, r.first_seq): (r.role, r.text) for r in chat_format.fold_events(events(spark, rows)).collect()}
    assert got == {(1, 1): ("user", "hi there"), (1, 2): ("assistant", "good day"), (2, 1): ("", "x"), (None, 1): ("user", "")}


def test_chat_round_trip_and_mask(spark):
    said = ["\\### Assistant: </turn> ok", "", "</turn>\n### user: \\b\\h\\l", "a\nb: c", "plain", "\\\\", None]
    rows = [(1, i, i, "user" if i % 2 else "assistant", "message", t) for i, t in enumerate(said)] + [(2, 0, 0, "odd: #role\\", "message", "z")]
    out = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chats(events(spark, rows))).collect()}
    assert [t.text for t in out[1].turns] == [t or "" for t in said]
    assert out[2].turns[0].role == "odd: #role\\"
    assert out[1].loss_text == "".join(t or "" for i, t in enumerate(said) if i % 2 == 0)
    for m in out[1].loss_mask:
        piece = out[1].formatted[m.offset : m.offset + m.length]
        assert piece.replace("\\l", "<").replace("\\h", "#").replace("\\b", "\\") == (said[m.turn] or "")


def fold_slowly(rows):
    """One event after the other."""
    logs = defaultdict(list)
    for conv, seq, msg, role, op, text in rows:
        logs[conv, msg].append((seq, chat_format.RESETS.get(op or "delta", 4 if op == "delete" else 3), text or "", role))
    out = {}
    for key, log in logs.items():
        log.sort(key=lambda e: (*e[:3], e[3] is not None, e[3]))
        text, name, gone = "", "", False
        for _, rank, said, role in log:
            name = name if role is None else role
            if rank == 4:
                text, gone = "", True
            elif rank == 3:
                text += said
            else:
                text, gone = said, False
        if not gone:
            out[key] = (log[0][0], name, text)
    return out


def test_fold_against_slow_fold(spark):
    rng = np.random.default_rng(11)
    ops = ["message", "start", "delta", "delta", "delta", "edit", "regenerate", "delete", None]
    rows = [(int(rng.integers(0, 40)), int(rng.integers(0, 12)), int(rng.integers(0, 3)), [None, "user", "assistant"][rng.integers(0, 3)], ops[rng.integers(0, len(ops))], [None, "a", "b#", "<c"][rng.integers(0, 4)]) for _ in range(1500)]
    rows += [(99, 1, 1, "user", "message", "secret"), (99, 2, 1, None, "delete", None), (99, 3, 1, None, "delta", "x"), (98, 1, 1, "user", "message", "old"), (98, 2, 1, None, "delete", None), (98, 3, 1, None, "start", ""), (98, 4, 1, None, "delta", "new")]
    want = fold_slowly(rows)
    got = {(r.conv_id, r.msg_id): (r.first_seq, r.role, r.text) for r in chat_format.fold_events(events(spark, rows)).collect()}
    assert got == want and (99, 1) not in got and got[98, 1][2] == "new"


def test_chat_empty(spark):
    assert chat_format.format_chats(events(spark, [])).count() == 0


def test_chat_digest_of_odd_tables(spark):
    """Empty table, null columns, a very long text, extra columns of clashing names."""
    schema = "conv_id long, turn long, role string, text string, seq string, op string, log int, e int"
    assert [r.conv_id for r in chat_format.chat_digest(spark.createDataFrame([], schema)).collect()] == [-7]
    long = "é# </turn> \\b " * 50_000
    rows = [(1, 0, "user", long, "s", "delete", 1, 1), (1, 1, "assistant", None, "s", "delete", 1, 1), (1, None, None, "x", "s", None, 1, 1), (None, 0, "assistant", long, None, None, None, None)]
    got = {r.conv_id: r for r in chat_format.chat_digest(spark.createDataFrame(rows, schema)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].turns_sha256 == sha(f"\nx\nuser\n{long}\nassistant\n\n") and got[1].loss_chars == 0
    assert got[None].loss_sha256 == sha(long) and got[None].loss_chars == len(long)


def test_chat_repeated_rows_stay(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    assert {r.conv_id: r.n_turns for r in chat_format.chat_digest(rows).collect()} == {1: 3, -7: 2}


# ---- 2 quality rules


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_statistics(spark):
    rows = [(r.doc_id, r.text) for r in small(spark, "documents").collect()] + [(10_000 + k, t) for k, (_, t) in enumerate(ODD)]
    rows += [(20_000, "a b c d e f g h " * 3), (20_001, "x\n y\nx\n\nx "), (20_002, "# | $\u00a0% a\x0bb")]
    got = {r.doc_id: r for r in quality_rules.quality_verdicts(docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r = got[i]
        n = base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n, i
        assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        assert not (r.base_failed and r.kept)


def test_quality_against_labels(spark):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_rules.quality_verdicts(d).join(labels, "doc_id").filter("not base_failed").collect()
    clean, junk = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(not r.kept for r in clean) <= 0.01 * len(clean)
    assert sum(r.kept for r in junk) <= 0.15 * len(junk)


@pytest.mark.parametrize("spread", [False, True])
@pytest.mark.parametrize("lang", ["en", "EN-gb", "xx"])  # shipped, shipped by another code, and one that the corpus has to tell
def test_quality_hot_junk(spark, lang, spread):
    """Junk of a source of its own (or of all sources) holds a third of the language's rows, and very long junk is there too."""
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    d = d.filter("lang = 'en'").withColumn("lang", F.lit(lang)).select("doc_id", "text", "lang", "source")
    failed = {r.doc_id: r.base_failed for r in quality_rules.quality_verdicts(d).collect()}
    junk = [r for r in d.join(labels.filter("quality = 0").select("doc_id"), "doc_id").collect() if not failed[r.doc_id]]
    n = d.count() // 2
    hot = [(-1 - k, r.text, lang, r.source if spread else "hot") for k, r in zip(range(n), itertools.cycle(junk))]
    hot.append((-1 - n, " ".join(f"%%a{i} ##b{i} &&c{i}" for i in range(100_000)), lang, "hot"))
    verdicts = common.cut(quality_rules.quality_verdicts(d.unionByName(spark.createDataFrame(hot, d.schema))))
    rows = verdicts.join(labels, "doc_id").filter("not base_failed").collect()
    clean, junk = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert len(clean) > 100 and len(junk) > 10
    assert sum(not r.kept for r in clean) <= 0.01 * len(clean)
    assert sum(r.kept for r in junk) <= 0.15 * len(junk)


@pytest.mark.parametrize("lang", ["de", "xx", None])
def test_quality_language_of_junk_only(spark, lang):
    junk = [(i, " ".join(f"%%a{i}x{k} ##b{k}$$" for k in range(600)), lang, "only") for i in range(3)]
    plain = [(10 + i, " ".join(f"漢字{i}x語{'ab'[k % 2]}語{chr(0x4E00 + k)}" for k in range(300)), "yy", "only") for i in range(3)]
    got = quality_rules.quality_verdicts(spark.createDataFrame(junk + plain, "doc_id long, text string, lang string, source string")).collect()
    assert {r.doc_id: r.kept for r in got if r.doc_id < 10} == {0: False, 1: False, 2: False}
    assert not any(r.base_failed for r in got)


def test_js_distance(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m) if a)
    row = spark.range(1).select(quality_rules.js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q))).alias("d")).first()
    assert row.d == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))


def test_quality_empty_and_passthrough(spark):
    assert quality_rules.quality_verdicts(docs(spark, [])).count() == 0
    d = small(spark, "documents").withColumn("body", F.lit(1)).withColumn("kept", F.lit(2))
    out = quality_rules.keep_good(d)
    assert out.columns == d.columns and 0 < out.count() < d.count()


# ---- 3 URL filters


def test_url_rules(spark):
    urls = [
        "https://www.example.com/en/1", "http://EXAMPLE.com/en/1", "http://a.example.com/en/", "http://x.com/", "http://x.com", "http://x.net/es/9?q",
        "http://net/fr/", "http://x.net/de", None, "nothing", "http://wwwxexample.com/en/", "http://h.org:80/a#b", "ftp://a://b/c?d", "http://b.www.example.com/en/x",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.page_verdicts(pages, spark.createDataFrame([], "doc_id long, quality int")).collect()}
    assert [got[i][2] for i in range(len(urls))] == ["www.example.com/en/", "example.com/en/", "example.com/en/", "com/", None, "net/es/", "net/fr/", None, None, None, "com/", None, None, "www.example.com/en/"]
    assert got[8] == ("", "", None, "allow") and got[9][:2] == ("", "") and got[11][:2] == ("h.org:80", "/a") and got[12][:2] == ("a:", "//b/c")
    assert got[1][3] == "block"


def test_reputation_blocks_only_sure_hosts(spark):
    rows = [("bad.example.org", 0)] * 200 + [("good.example.org", 1)] * 200 + [("once.example.org", 0)] + [(f"h{i}.example.org", 1) for i in range(40)] + [("null.example.org", None)]
    marks = spark.createDataFrame(rows, "host string, good int")
    fame = {r.host: r for r in url_filter.host_reputation(marks, spark.createDataFrame([("new.b.co.uk",)], "host string")).collect()}
    assert fame["bad.example.org"].reputation == "block"
    assert fame["good.example.org"].reputation == "allow" and fame["once.example.org"].reputation == "allow"
    assert (fame["new.b.co.uk"].suffix, fame["new.b.co.uk"].domain) == ("co.uk", "b.co.uk")
    assert fame["once.example.org"].good_mean > fame["bad.example.org"].good_mean
    assert "null.example.org" not in fame


def test_beta_tail(spark):
    """The series against a fine sum over the density, and the verdict on both sides of the bound."""
    import math

    cases = [(0.3, 0.7), (1, 1), (2, 9), (0.01, 3), (40, 90), (900, 1100), (2300, 2650), (1, 400)]
    x = 0.5
    u = np.linspace(0, 40, 4_000_001)  # logit of the rate, from 1/2 up

    def above(a, b):
        logs = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) - a * np.log1p(np.exp(-u)) - b * np.log1p(np.exp(u))
        return np.trapezoid(np.exp(logs), u)

    df = spark.createDataFrame([(float(a), float(b)) for a, b in cases], "a double, b double")
    got = df.select("a", "b", url_filter.lower_tail(F.col("b"), F.col("a"), 1 - x).alias("p"), url_filter.surely_below(F.col("a"), F.col("b"), x).alias("below")).collect()
    for r in got:
        want = above(r.a, r.b)
        assert r.p == pytest.approx(want, rel=1e-6, abs=1e-12), r
        assert r.below == (r.a / (r.a + r.b) < x and want < 0.025)
    assert {r.below for r in got} == {True, False}
    big = spark.createDataFrame([(49_000.0, 51_000.0), (49_900.0, 50_100.0)], "a double, b double").select(url_filter.surely_below(F.col("a"), F.col("b"), x).alias("below"))
    assert [r.below for r in big.collect()] == [True, False]


def test_addresses_and_hosting_are_domains_of_their_own(spark):
    hosts = ["10.0.0.1", "99.7.0.1:80", "[::1]:8080", "a.github.io", "x.a.github.io", "github.io", "b.c.co.uk", "h", "", "1.2.3.4.5"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = {r[0]: (r[1], r[2]) for r in df.select("host", url_filter.suffix_of(F.col("host")).alias("s"), url_filter.domain_of(F.col("host"), url_filter.suffix_of(F.col("host"))).alias("d")).collect()}
    assert got == {
        "10.0.0.1": ("", "10.0.0.1"), "99.7.0.1:80": ("", "99.7.0.1"), "[::1]:8080": ("", "[::1]"), "a.github.io": ("github.io", "a.github.io"), "x.a.github.io": ("github.io", "a.github.io"),
        "github.io": ("io", "github.io"), "b.c.co.uk": ("co.uk", "c.co.uk"), "h": ("h", "h"), "": ("", ""), "1.2.3.4.5": ("5", "4.5"),
    }


def test_planted_bad_host_is_blocked(spark):
    """A host of bad pages, one of good ones under the same domain, strangers on a hosting service; pages with null and repeated ids,
    extra columns, a very long url."""
    long = "http://new.example.org/" + "x" * 200_000
    urls = ["http://bad.example.org/p", "http://good.example.org/p", "http://spam.github.io/", "http://fine.github.io/", "http://10.0.0.1/", "http://99.7.0.1/", long, None]
    pages = spark.createDataFrame([(i, u, "h", 1, "x") for i, u in enumerate(urls)] + [(0, urls[0], "h", 1, "x"), (None, urls[0], "h", 1, "x")], "page_id long, url string, html string, host_n int, verdict string")
    marks = [(urls[k], g) for k, g in ((0, 0), (1, 1), (2, 0), (3, 1), (4, 0), (5, 1)) for _ in range(60)]
    got = [(r.page_id, r.verdict) for r in url_filter.judge_urls(pages, spark.createDataFrame(marks, "url string, good int")).collect()]
    assert sorted(got, key=str) == sorted([(0, "block"), (0, "block"), (None, "block"), (1, "allow"), (2, "block"), (3, "allow"), (4, "block"), (5, "allow"), (6, "allow"), (7, "allow")], key=str)
    none = spark.createDataFrame([], "url string, good int")
    assert url_filter.judge_urls(pages.limit(0), none).count() == 0 and {r.verdict for r in url_filter.judge_urls(pages, none).collect()} == {"allow"}


# ---- 4 toxicity


def test_toxicity_held_out(spark):
    d, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    labelled = d.join(labels.select("doc_id"), "doc_id")
    rows = toxicity.toxicity_scores(labelled, labels).join(labels, "doc_id").filter("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit / max(1, sum(r.predicted for r in rows)) >= 0.9
    assert hit / sum(r.toxic for r in rows) >= 0.85


def test_counterfactual_penalty(spark):
    rows = [(f"those muslims are bad stupid number{i}", 1) for i in range(40)] + [(f"a fine day number{i}", 0) for i in range(40)]
    train = spark.createDataFrame(rows, "text string, toxic int")
    plain, fair = toxicity.fit(train, penalty=0.0), toxicity.fit(train, penalty=50.0)
    neutral = ["muslims had a fine day"]
    assert fair.score_texts(neutral)[0] < plain.score_texts(neutral)[0]
    assert fair.score_texts(["so stupid"])[0] > 0.5
    same = ["the muslims walk", "the jews walk"]
    assert abs(np.subtract(*fair.score_texts(same))) <= abs(np.subtract(*plain.score_texts(same))) + 1e-9


GROUPS = {lang: kinds[2][:3] for lang, kinds in toxicity.IDENTITY_TERMS.items()}
FRAMES = {"en": "{} met at the market", "de": "{} trafen sich am markt", "fr": "{} se retrouvent au marché", "es": "{} se ven en el mercado"}


def test_counterfactual_lowers_false_positives(spark):
    """Training texts insult one group of each language more than others; neutral mentions of it must not be punished."""
    rows = []
    for lang, (first, second, third) in GROUPS.items():
        for i in range(60):
            rows += [(f"{first} vermin{i % 5} filth x{i}", 1), (f"{FRAMES[lang].format(second if i % 2 else third)} y{i}", 0), (f"vermin{i % 5} filth {third} z{i}", 1 if i < 6 else 0) if i < 6 else (f"y{i} quiet day {lang}", 0)]
    train = spark.createDataFrame(rows, "text string, toxic int")
    neutral = [FRAMES[lang].format(group) for lang, groups in GROUPS.items() for group in groups]
    toxic = [f"{group} vermin1 filth" for groups in GROUPS.values() for group in groups]
    wrong = {}
    for penalty in (0.0, 20.0):
        model = toxicity.fit(train, penalty=penalty)
        assert model.n_rows == len(rows) and model.n_twins >= 60 * 2 * 4
        wrong[penalty] = sum(x >= 0.5 for x in model.score_texts(neutral)), np.mean(model.score_texts(neutral[::3]))
        assert all(x > 0.5 for x in model.score_texts(toxic))
    assert wrong[20.0][0] <= wrong[0.0][0] and wrong[20.0][1] < 0.6 * wrong[0.0][1], wrong


def test_swapped_terms():
    assert toxicity.swapped("Die Frauen und Männer") == "die männer und mädchen"
    assert toxicity.swapped("les juifs, étrangers") == "les hindous immigrés" and toxicity.swapped("nada") is None
    assert all(t in toxicity.SWAP and toxicity.SWAP[t] in toxicity.SWAP for kinds in toxicity.IDENTITY_TERMS.values() for kind in kinds for t in kind)


def test_toxicity_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs(spark, ODD), none).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity_scores(docs(spark, []), none).count() == 0
    one = spark.createDataFrame([(4, 1), (4, None)], "doc_id long, toxic int")
    assert toxicity.toxicity_scores(docs(spark, ODD), one).count() == len(ODD)
    odd = docs(spark, ODD)
    for name in ("score", "score_", "__text", "c0", "__id"):
        odd = odd.withColumn(name, F.lit("own"))
    kept = toxicity.drop_toxic(odd, none)
    assert kept.columns == odd.columns and kept.count() == len(ODD) and {(r.score, r.c0) for r in kept.collect()} == {("own", "own")}
    with pytest.raises(ValueError):
        toxicity.score(odd, toxicity.Model({}, 0.0), ("doc_id", "score"))


# ---- 5 decontamination


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def grams_of(text, n=5):
    w = words_of(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


@pytest.mark.parametrize("options", [{}, {"max_probes": 0, "max_item_bytes": 0, "max_pairs": 0}])
def test_containment_brute_force(spark, options):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(5, 60)))) for i in range(30)]
    items += [(100, "W7, w8"), (101, None), (None, "a b c d e f"), (102, "w1 w2 w3 w4"), (103, "?!"), (104, "w9"), (105, "a a a a a a a"), (100, "w7 w8")]
    texts = []
    for k in range(60):
        item = items[k % 30][1].split()
        cut = item[: max(5, int(len(item) * rng.choice([0.6, 0.85, 1.0])))]
        texts.append((k, " ".join([*rng.choice(vocabulary, 200), *cut, *rng.choice(vocabulary, 50)]).upper() + "!"))
    texts += [(7, texts[7][1]), (8, texts[9][1]), (900, None), (901, ""), (None, items[0][1]), (902, "w1 w2 w3 w4"), (903, "w7"), (904, (items[3][1] + " ") * 300)]
    got = decontaminate.contained_items(docs(spark, texts), spark.createDataFrame(items, "item_id long, text string"), **options)
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in got.collect()}
    want = {}
    for (i, t), (j, s) in itertools.product(texts, items):
        k = min(5, len(words_of(s)))
        g = grams_of(s, k) if k else set()
        n = len(g & grams_of(t, k))
        if i is not None and j is not None and g and n >= 0.8 * len(g) - 1e-9:
            want[i, j] = max(want.get((i, j), (0, 0)), (n, len(g)))
    assert got == want and len(want) > 20
    bad = {t for t in {t for _, t in texts if t} if any(grams_of(s, min(5, len(words_of(s)))) and len(grams_of(s, min(5, len(words_of(s)))) & grams_of(t, min(5, len(words_of(s))))) >= 0.8 * len(grams_of(s, min(5, len(words_of(s))))) - 1e-9 for i, s in items if i is not None and words_of(s))}
    rest = decontaminate.drop_contaminated(docs(spark, texts), spark.createDataFrame(items, "item_id long, text string"), **options)
    assert sorted((r.doc_id or -1, r.text or "") for r in rest.collect()) == sorted((i or -1, t or "") for i, t in texts if t not in bad)


def test_repeated_shingle_is_probed_once(spark):
    """A document that repeats an item's shingles gives each of them to the search once."""
    item = " ".join(f"q{i}" for i in range(40))
    rows = docs(spark, [(1, (item + " ") * 500), (2, "q0 q1 q2 q3 q4 " * 5000)])
    got = decontaminate.contained_items(rows, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.n_shared, r.n_item) for r in got] == [(1, 36, 36)]


def test_decontamination_keeps_rest(spark):
    d, b = small(spark, "documents"), small(spark, "benchmark")
    found = {r.doc_id for r in decontaminate.leaks(d, b).collect()}
    left = decontaminate.drop_contaminated(d.withColumn("__leak", F.lit(1)).withColumn("words", F.lit(2)), b)
    assert left.columns == [*d.columns, "__leak", "words"] and left.count() == d.count() - len(found)
    assert decontaminate.leaks(d, b.limit(0)).count() == 0
    assert decontaminate.leaks(d.limit(0), b).count() == 0 == decontaminate.drop_contaminated(d.limit(0), b).count()


# ---- 6 token counts


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_equal_library(spark, name):
    import public_tokenizers

    rows = ODD + [(100 + r.doc_id, r.text) for r in small(spark, "documents").limit(80).collect()] + [(50, "x" * 5000), (51, " lead and  two   spaces \n\n next\u3000wide ")]
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs(spark, rows), name, batch_bytes=5000, cache_units=50).collect())
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(public_tokenizers.path(name))
        n = lambda s: len(t.encode(s, add_special_tokens=False))
    else:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        n = lambda s: len(p.encode(s))
    assert got == sorted((i or -1, len((t or "").encode()), n(t or ""), n(t or "") > 512) for i, t in rows)
    assert token_counts.count_tokens(docs(spark, [])).count() == 0


def test_added_tokens_with_spaces_are_not_split(tmp_path):
    import json

    import public_tokenizers

    plain = json.load(open(public_tokenizers.path("byte_bpe_50k.json")))
    for change, safe in (({}, True), ({"content": "<a b>"}, False), ({"content": "<ab>", "lstrip": True}, False)):
        t = json.loads(json.dumps(plain))
        if change:
            t["added_tokens"].append({"id": 60_000, "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False} | change)
        path = tmp_path / "t.json"
        path.write_text(json.dumps(t))
        encode, found = token_counts.load_encoder(str(path))
        assert found == safe
        text = "an x <a b> y <ab> z"
        assert token_counts.unit_counter(encode, found, 10)([text]) == encode([text])


# ---- 7 license scans


def test_license_texts(spark):
    mit = license_scan.LICENSE_TEXTS[0][1]
    changed = mit.upper().replace("SUBLICENSE", "sub-licence").replace("MIT LICENSE\n", "MIT Licence\n\nCopyright (c) 2024 Somebody\n") + "\n\n--"
    rows = [(1, mit), (2, changed), (3, mit + " and more"), (4, "Hello\nreleased under the MIT  licence!!\nAll rights reserved."), (5, None), (6, ""), (7, "..."), (1, mit)]
    got = defaultdict(list)
    for r in license_scan.scan(docs(spark, rows)).collect():
        got[r.doc_id].append((r.license, list(r.notices)))
    assert got[1] == [("MIT", [])] * 2 and got[2] == [("MIT", [])] and got[3] == [(None, [])]
    assert got[4] == [(None, ["MIT", "all-rights-reserved"])]
    assert got[5] == got[6] == got[7] == [(None, [])]
    digest = license_scan.scan(docs(spark, [(4, "A-b, C")])).first().text_digest
    same = {r.doc_id: r.text_digest for r in license_scan.scan(docs(spark, [
        (1, "licence licence\n\u00a9 2020 x\nthe copyright owner"), (2, "License, license! The copyright holder"), (3, "licence licence licence " * 50_000), (4, "license " * 150_000), (5, "Copyright <YEAR> <OWNER>\nlicence"), (6, "license")
    ])).collect()}
    assert same[1] == same[2] and same[3] == same[4] and same[5] == same[6]
    with pytest.raises(ValueError):
        license_scan.scan(docs(spark, []), notices=[("x", f"notice {i}") for i in range(1001)])
    assert digest == hashlib.sha256(b"a b c").hexdigest()
    assert license_scan.scan(docs(spark, []), notices=()).count() == 0


def test_license_common_texts_and_variants(spark):
    shipped = [(n, t) for n, t in license_scan.MORE_TEXTS]
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0"} <= {n for n, _ in shipped}
    assert all("licen" in t.lower() or "software" in t.lower() for _, t in shipped)
    grant, isc, bsd = license_scan.LICENSE_TEXTS[1][1], license_scan.LICENSE_TEXTS[2][1], license_scan.LICENSE_TEXTS[5][1]
    odd = [
        ("MIT", "The MIT License (MIT)\n\nCopyright (c) Some Body\nAll rights reserved.\n\n" + grant), ("ISC", isc.replace("ISC License\n\n", "Copyright Some Body\n\n")),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, X\nAll rights reserved.\n\n" + bsd), (None, "Copyright X\n" + grant + " not"),
    ]
    rows = [*shipped, *odd]
    got = {r.doc_id: r.license for r in license_scan.scan(docs(spark, [(i, t) for i, (_, t) in enumerate(rows)])).collect()}
    assert [got[i] for i in range(len(rows))] == [n for n, _ in rows]
    lines = [
        "// SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0)", "This file is licensed under the Mozilla Public License, v. 2.0.", "Distributed under the terms of the GNU LGPL v2.1 or later",
        "Licensed under CC BY-SA 4.0", "we saw it under the Apache tent",
    ]
    got = {r.doc_id: list(r.notices) for r in license_scan.scan(docs(spark, [(i, "x\n" + t) for i, t in enumerate(lines)])).collect()}
    assert got == {0: ["GPL-2.0-only", "MIT"], 1: ["MPL-2.0"], 2: ["LGPL-2.1"], 3: ["CC-BY-SA-4.0"], 4: []}


# ---- 8 packing


def slow_best_fit(sizes, sources, clusters, capacity):
    bins, where = [], []
    for i in np.argsort(-sizes, kind="stable"):
        fits = [(room, b) for b, (room, s, c) in enumerate(bins) if room >= sizes[i] and sources[i] not in s and clusters[i] not in c]
        if fits:
            b = min(fits)[1]
        else:
            bins.append([capacity, set(), set()])
            b = len(bins) - 1
        bins[b][0] -= sizes[i]
        bins[b][1].update({sources[i]} - {None})
        bins[b][2].update({clusters[i]} - {None})
        where.append((int(i), bins[b][0]))
    return len(bins), where


@pytest.mark.parametrize("n_sources", [3, 200])
def test_best_fit_is_tightest(n_sources):
    rng = np.random.default_rng(n_sources)
    n = 600
    sizes = rng.integers(0, 120, n)
    sources = [None if x == 0 else f"s{x}" for x in rng.integers(0, n_sources, n)]
    clusters = [None if x < 3 else f"c{x}" for x in rng.integers(0, 250, n)]
    where, offset = packing.best_fit(sizes, sources, clusters, 200)
    count, order = slow_best_fit(sizes, sources, clusters, 200)
    assert len(set(where)) == count
    assert [200 - offset[i] - sizes[i] for i, _ in order] == [room for _, room in order]


def test_packing_is_whole_and_legal(spark):
    rows = [(r.doc_id, r.text) for r in small(spark, "documents").collect()] + ODD
    got = packing.pack(docs(spark, rows), 2000, 70).collect()
    total = Counter()
    for r in got:
        total[r.doc_id] += r.size
    want = Counter()
    for i, t in rows:
        want[i] += len(t or "")
    assert total == want
    bins = defaultdict(list)
    for r in got:
        bins[r.bin_id].append(r)
    for members in bins.values():
        assert sum(r.size for r in members) <= 2000
        assert len({r.source for r in members}) == len(members)
        named = [r.cluster for r in members if r.cluster]
        assert len(set(named)) == len(named)
        at = 0
        for r in sorted(members, key=lambda r: (r.bin_offset, r.size)):
            assert r.bin_offset == at
            at += r.size
    assert packing.pack(docs(spark, [])).count() == 0


# ---- 9 sharding


def test_shards_exact_and_whole(spark):
    import zlib

    rows = [(r.doc_id, r.text) for r in small(spark, "documents").collect()] + ODD
    d = docs(spark, rows).repartition(7)
    got = sharding.shard(d, 6, bucket_rows=10).collect()
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted((i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(6)]
    assert max(sizes) - min(sizes) <= 1
    assert sharding.shard(docs(spark, []), 6).count() == 0
    assert sharding.shard(docs(spark, ODD[:3]), 40).count() == 3


def test_communication_matrix_law():
    sizes = [5, 0, 11, 4]
    total = np.zeros((4, 3))
    for seed in range(400):
        m = sharding.communication_matrix(sizes, 3, seed)
        assert m.sum(1).tolist() == sizes and sorted(m.sum(0).tolist()) == [6, 7, 7]
        total += m
    assert abs(total / 400 - np.outer(sizes, [7, 7, 6]) / 20).max() < 0.3
    big = [sharding.draw_hypergeometric(np.random.default_rng(s), 3 * 10**9, 10**9, 4000) for s in range(200)]
    assert abs(np.mean(big) - 3000) < 10 and 15 < np.std(big) < 40


def test_shuffle_is_uniform(spark):
    """Where rows come from tells nothing about their shard or their place in it."""
    n, shards, parts = 40_000, 8, 10
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).repartitionByRange(parts, "doc_id")
    got = sharding.shard(rows, shards, bucket_rows=1000).toPandas()
    for column, cells in (("shard", shards), ("place", 5)):
        got["place"] = got["slot"] * 5 // (n // shards)
        counts = np.zeros((parts, cells))
        np.add.at(counts, (got["doc_id"].to_numpy() * parts // n, got[column].to_numpy()), 1)
        want = n / parts / cells
        assert ((counts - want) ** 2 / want).sum() < parts * cells + 5 * np.sqrt(2 * parts * cells), column
    # neighbours of the input are no neighbours of the output
    assert abs(np.corrcoef(got["doc_id"], got["slot"])[0, 1]) < 0.03


# ---- 10 n-gram Jaccard join


def shingles_of(text):
    w = re.findall(r"\w+", text.lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, threshold=0.8):
    texts = {}
    for i, t in rows:
        if t is not None and i is not None:
            texts.setdefault(t, set()).add(i)
    names = list(texts)
    sets = {t: shingles_of(t) for t in names}
    parent = {i: i for ids in texts.values() for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def tie(a, b):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)

    links = Counter()
    for t, ids in texts.items():
        for i in ids:
            tie(min(ids), i)
    post = defaultdict(set)
    for t in names:
        for g in sets[t]:
            post[g].add(t)
    for t in names:
        for s in {x for g in sets[t] for x in post[g]}:
            if s != t and len(sets[t] & sets[s]) >= threshold * len(sets[t] | sets[s]) - 1e-9:
                links[t] += 1
                tie(min(texts[t]), min(texts[s]))
    return {i: (root(i), links[t]) for t, ids in texts.items() for i in ids}


def test_jaccard_join_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rng = np.random.default_rng(1)
    base_words = [f"v{x}" for x in rng.integers(0, 500, 120)]
    for k in range(60):  # a group of near copies, cut in blocks below
        w = list(base_words)
        w[int(rng.integers(0, 120))] = f"z{k}"
        rows.append((5000 + k, " ".join(w)))
    rows += [(6000, None), (6001, ""), (6002, "   "), (6003, "two words"), (6004, "Two  words!"), (6005, ""), (5000, dict(rows)[5000])]
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.jaccard_join(docs(spark, rows), block_rows=20, text_block_rows=16, text_block_bytes=5000).collect()}
    want = brute(rows) | {6000: (6000, 0)}
    assert got == want
    assert sum(1 for c, n in want.values() if n) > 60
    shuffled = ngram_join.jaccard_join(docs(spark, rows), max_broadcast=0)
    assert {r.doc_id: (r.class_id, r.n_links) for r in shuffled.collect()} == want


def test_jaccard_join_odd_rows(spark):
    got = ngram_join.jaccard_join(docs(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert by[7].class_id == 6 and by[6].n_copies == 2 and by[None].class_id is None and by[1].class_id == 1
    assert ngram_join.jaccard_join(docs(spark, [])).count() == 0
    kept = ngram_join.keep_one(docs(spark, ODD))
    assert kept.columns == docs(spark, []).columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 6, 8]


LONG = " ".join(f"u{i}" for i in range(60))
NEAR = LONG.replace("u30 ", "x30 ")


@pytest.mark.parametrize("limit", [2_000_000, 0])
@pytest.mark.parametrize("text_ids", [False, True])
def test_keep_one_decides_by_row(spark, text_ids, limit):
    """Repeated rows, repeated ids with different texts, and null ids."""
    other = " ".join(f"o{i}" for i in range(40))
    rows = [(5, LONG), (5, LONG), (5, "a text of its own, with enough words"), (3, NEAR), (3, NEAR), (3, NEAR), (None, LONG), (None, other), (None, other), (9, None), (9, None), (None, None)]
    df = docs(spark, rows)
    if text_ids:
        df = df.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    kept = sorted((str(r.doc_id), r.text or "") for r in ngram_join.keep_one(df, max_broadcast=limit).collect())
    name = lambda i: str(i) if i is None else f"{'d' * text_ids}{i}"
    want = [(5, rows[2][1]), (3, NEAR), (None, other), (9, ""), (9, ""), (None, "")]
    assert kept == sorted((name(i), t) for i, t in want)
    joined = ngram_join.jaccard_join(df, max_broadcast=limit).collect()
    assert len(joined) == len(rows)
    assert sorted((str(r.doc_id), str(r.class_id), r.n_copies, r.n_links) for r in joined) == sorted(
        [(name(5), name(3), 3, 1)] * 2 + [(name(5), name(5), 1, 0)] + [(name(3), name(3), 3, 1)] * 3 + [("None", name(3), 3, 1)] + [("None", "None", 2, 0)] * 2 + [(name(9), name(9), 1, 0)] * 2 + [("None", "None", 1, 0)]
    )


def test_broadcast_bound_counts_blocks(spark):
    size = spark.createDataFrame([(300_000, 5), (2, 90), (1001, 5)], "n long, bytes long")
    blocks = ngram_join.n_blocks(1000, 30)
    assert ngram_join.broadcast_rows(size, blocks) == 300_000 * 300 + 2 * 2 + 1001 * 2
    assert ngram_join.broadcast_rows(size.limit(0), blocks) == 0


def test_posterior_bounds():
    least = ngram_join.least_matches(0.8, 1e-6)
    assert least == sorted(least) and 0 < least[0] < 16 and least[-1] < 0.8 * 128
    assert ngram_join._beta_tail(1, 1, 0.8) == pytest.approx(0.2)


# ---- shared


def test_window_hashes(spark):
    df = spark.createDataFrame([("a b c d e f g h i a b c d e f g h",), ("x y",), ("",), (" p  q\tr\ns t ",)], "t string")
    df = df.select(common.held(common.split_words(F.col("t"))).alias("w"))
    for n in (1, 2, 3, 5, 8):
        for r in common.with_window_hashes(df, "w", n, "h").select("h", common.window_texts(F.col("w"), n).alias("x")).collect():
            assert len(r.h) == len(r.x)
            assert len(set(r.h)) == len(set(r.x)) and dict(zip(r.x, r.h, strict=True)).keys() == set(r.x)


def test_pipeline(spark):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["quality", "toxicity", "near_duplicates", "decontamination", "packing"]
    d = small(spark, "documents")
    seen, rows = d.count(), d
    for name, stage in p.STAGES[:-1]:
        out = common.cut(stage(spark, rows, SMALL))
        assert out.columns == d.columns
        assert 0 < out.count() <= seen
        rows, seen = out, out.count()
    left = {r.doc_id for r in rows.collect()}
    assert {r.doc_id for r in p.run(spark, SMALL).collect()} == left


def test_pipeline_odd_tables(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows, extra columns; and empty tables."""
    import corpus_pipeline as p

    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, __row string"
    prose = [r for r in small(spark, "documents").filter("lang = 'en'").join(small(spark, "labels").filter("quality = 1 and toxic = 0").select("doc_id"), "doc_id").collect() if len(r.text.split()) >= 60][:6]
    item = " ".join(f"item{i}" for i in range(20))
    rows = [(i, r.text, "en", "s", 1, "a", "b") for i, r in enumerate(prose)]
    rows += [rows[0], rows[0], (None, prose[1].text, None, None, None, None, None), (0, prose[2].text, "xx", "s", 1, "a", "b"), (50, None, "en", "s", 1, "a", "b"), (51, "", None, None, None, None, None)]
    rows += [(52, prose[3].text + " " + item, "en", "s", 1, "a", "b"), (None, prose[4].text + "\n" + item, "en", "s", 1, "a", "b"), (53, " ".join(f"{w} w{k}" for k in range(400) for w in prose[5].text.split()), "en", "s", 1, "a", "b")]

    def tables(name, docs, items):
        for t, df in (("documents", spark.createDataFrame(docs, schema)), ("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int")), ("benchmark", spark.createDataFrame(items, "item_id long, text string"))):
            df.write.parquet(str(tmp_path / name / f"{t}.parquet"))
        return str(tmp_path / name)

    at = tables("odd", rows, [(1, item), (None, "x y z"), (2, None), (3, "")])
    seen = spark.read.parquet(f"{at}/documents.parquet")
    for _, stage in p.STAGES[:-1]:
        seen = common.cut(stage(spark, seen, at))
        assert seen.columns == [f.split()[0] for f in schema.split(", ")]
    left = Counter((r.doc_id, r.text) for r in seen.collect())
    assert all(item not in t for _, t in left) and max(left.values()) == 1 and len({t for _, t in left}) == len(left)
    assert {t for _, t in left} >= {prose[0].text, prose[1].text} - {prose[3].text, prose[4].text} and None not in {t for _, t in left}
    before = set(common.marked())
    assert {r.doc_id for r in p.run(spark, at).collect()} == {i for i, _ in left}
    assert len(set(common.marked()) - before) <= 3  # the last stage's own and its input
    empty = tables("empty", [], [])
    assert p.run(spark, empty).count() == 0
