"""Text operators against plain versions: odd rows, empty tables, clashing columns, whole registered queries."""

import collections
import hashlib
import math
import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from compare import differences, duck
from conftest import SF
from pyspark.sql import functions as F

from cartwheel.llm import bpe, context_mixing, language, lines, mixing, secrets, shingles, toxicity
from cartwheel.llm.queries import ORACLES, QUERIES, mixing_attributes, rank_file
from cartwheel.scratch import write_table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, block int, ids string, _p int"
LONG = "the long text goes on and on\n" * 4000


def docs_of(spark, rows):
    """Rows of (doc_id, text, lang, source), with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, g, s, None, "x", 1, "y", 2) for i, t, g, s in rows], DOCS)


ODD = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, "   \n\t ", None, "a"),
    (4, LONG, "en", "b"),
    (5, "Same words here, twice over.", "fr", "b"),
    (5, "Same words here, twice over.", "fr", "b"),
    (None, "no id at all", "de", "c"),
    (7, "αβγ déjà vu    x\x00y 12345", "el", "c"),
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas()


def crc(key, folds):
    return zlib.crc32(b"" if key is None else str(key).encode()) % folds


# ---- byte-level BPE ----


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(*rank_file())


@pytest.fixture(scope="module")
def library():
    path, pattern = rank_file()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def test_bpe_matches_the_library(codec, library):
    random = np.random.default_rng(4)
    letters = list(" \n\t\x1c   \x85ab'sé1!Z日᠎​\x00")
    texts = ["".join(random.choice(letters, random.integers(0, 14))) for _ in range(3000)]
    texts += ["".join(random.choice(list("aabein"), random.integers(1, 500))) for _ in range(100)]
    texts += ["ab" * 50_000, "don't  it's 'll", " lead", "trail ", "a  b", "a \n b", "<|endoftext|>"]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_bpe_lower_rank_made_by_a_merge_goes_first():
    """The pair that a merge makes may rank below the merge itself; equal ranks go from left to right."""
    ranks = {bytes([c]): k for k, c in enumerate(b"abc")} | {b"bc": 3, b"aa": 5, b"ab": 6, b"aab": 4}
    codec = bpe.Codec(ranks, r"\S+")
    library = tiktoken.Encoding("tiny", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    words = ["aab", "aaab", "aaaab", "aaabaab", "aabcaab", "aaaaaa", "abcabc"]
    for word, ids in zip(words, codec.merge([w.encode() for w in words]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library._core_bpe.encode_ordinary(word), word


def test_bpe_on_odd_rows(spark):
    path, pattern = rank_file()
    out = bpe.decode_ids(bpe.encode_texts(docs_of(spark, ODD), "text", path, pattern), path, pattern)
    rows = out.collect()
    assert sorted((r.decoded.decode() for r in rows)) == sorted(t or "" for _, t, _, _ in ODD)
    assert all(len(r.ids) == 4 * r.n_tokens and r.score == "x" for r in rows)
    assert bpe.encode_texts(docs_of(spark, []), "text", path, pattern).count() == 0


def test_bpe_query(spark, table, library):
    rows = {r.doc_id: r for r in QUERIES["op9_bpe"](spark, SF).collect()}
    for key, text in zip(table.doc_id, table.text, strict=True):
        ids = np.array(library.encode_ordinary(text), "<u4")
        assert rows[key].n_tokens == len(ids)
        assert rows[key].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert rows[key].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


# ---- queries with an SQL twin ----


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_twin(spark, name):
    ours = QUERIES[name](spark, SF).toArrow()
    assert differences(ours, duck(SF).sql(ORACLES[name]).to_arrow_table()) is None


# ---- line windows ----


def cut_lines(rows):
    """First occurrences by id and position; later windows go."""
    seen, gone = set(), collections.defaultdict(set)
    for key, text in rows:
        parts = (text or "").split("\n")
        full = [i for i, x in enumerate(parts) if re.search(r"[^ \t-\r]", x)]
        for k in range(len(full) - 2):
            window = tuple(parts[i] for i in full[k : k + 3])
            if window in seen:
                gone[key].update(full[k : k + 3])
            seen.add(window)
    return {k: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[k]) for k, t in rows}


def test_lines_against_plain_version(spark):
    random = np.random.default_rng(8)
    rows = [(i, "\n".join(random.choice(["a", "b", "c", "", " "], random.integers(0, 12)))) for i in range(120)]
    rows += [(120, None), (121, ""), (122, "a\na\na\na\na"), (123, LONG)]
    df = docs_of(spark, [(i, t, "en", "s") for i, t in rows]).withColumn("lines_removed", F.lit("old"))
    found = {r.doc_id: r for r in lines.drop_repeated_windows(df, "doc_id", "text").collect()}
    assert {k: r.text for k, r in found.items()} == cut_lines(rows)
    assert found[120].text is None and found[121].lines_removed == 0
    assert found[123].text.count("the long") == 1


def test_lines_on_odd_rows(spark):
    out = lines.drop_repeated_windows(docs_of(spark, ODD), "doc_id", "text").collect()
    assert len(out) == len(ODD)
    assert lines.drop_repeated_windows(docs_of(spark, []), "doc_id", "text").count() == 0


# ---- mixing ----


def test_mixing_meets_marginals(spark):
    random = np.random.default_rng(6)
    rows = [
        (i, "w " * int(random.integers(1, 30)), ["en", "de", None][random.integers(3)], "big" if i % 3 else f"s{i % 4}") for i in range(3000)
    ]
    by = {"source": F.col("source"), "lang": F.col("lang")}
    mixed = mixing.mix(docs_of(spark, rows), "doc_id", "text", by, power=0.0, sweeps=20).toPandas()
    words = mixed.text.str.split().str.len()
    for name in ("_by_source", "_by_lang"):
        share = (words * mixed._cell_weight).groupby(mixed[name]).sum() / words.sum()
        assert np.allclose(share, 1 / len(share), atol=1e-6)
    assert abs((words * mixed._keep_probability).sum() / words.sum() - mixing.BUDGET) < 0.01
    assert abs(words[mixed._kept].sum() / words.sum() - mixing.BUDGET) < 0.05


def test_keep_probabilities_meet_marginals(spark):
    random = np.random.default_rng(7)
    rows = [
        (i, "w " * int(random.integers(1, 30)), "de" if random.random() < 0.1 else "en", "rare" if random.random() < 0.05 else "big") for i in range(3000)
    ]
    by = {"source": F.col("source"), "lang": F.col("lang")}
    mixed = mixing.mix(docs_of(spark, rows), "doc_id", "text", by, power=0.5, sweeps=8, meet=True).toPandas()
    words = mixed.text.str.split().str.len()
    held = words * mixed._keep_probability
    for name in ("_by_source", "_by_lang"):
        tempered = words.groupby(mixed[name]).sum() ** 0.5
        assert np.allclose(held.groupby(mixed[name]).sum() / held.sum(), tempered / tempered.sum(), atol=1e-3)
    assert mixed._keep_probability.max() <= 1 and 0.1 < held.sum() / words.sum() <= mixing.BUDGET


def test_mixing_on_odd_rows(spark):
    out = mixing.mix(docs_of(spark, ODD), "doc_id", "text", mixing_attributes())
    assert out.count() == len(ODD) and out.filter("_keep_probability IS NULL OR _kept IS NULL AND doc_id IS NOT NULL").count() == 0
    assert mixing.mix(docs_of(spark, []), "doc_id", "text", mixing_attributes()).count() == 0


# ---- secrets ----

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def base_spans(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def test_secret_base_spans(spark, table):
    found = {r.doc_id: r for r in QUERIES["op6_secrets"](spark, SF).collect()}
    for key, text in zip(table.doc_id, table.text, strict=True):
        assert found[key].base_sha256 == hashlib.sha256(base_spans(text).encode()).hexdigest()
    texts = [
        "secret: token: abcdefgh12 TOKEN = 'abcd1234' ſecret=abcdefgh1",
        "é api_key=\"abc\" apikey='A.b-c/d+e=f' passwd:12345678",
        "AKIAAKIAAKIA AKIAAKIAAKIA1234 " + "f" * 31 + " " + "0a" * 20,
        "password= password=hunter2hunter2",
    ]
    for text in texts:
        spans = [x for x in secrets.spans_of(text) if x[0] != "random"]
        assert ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans) == base_spans(text), text


def test_secret_ownership(spark):
    key, shared, mine = "Zk3Jd8sQ1pWm5Xr7Tb2L", "Qw8Er3Ty6Ui1Op4As9Df", "password=onlymine99"
    rows = [(i, f"copied {shared} here {mine if i == 3 else ''}", "en", f"o{i}") for i in range(5)]
    rows += [(9, f"live {key}", "en", "o1"), (10, None, "en", None)]
    found = {r.doc_id: r.spans for r in secrets.find_secrets(docs_of(spark, rows), "doc_id", "text", "doc_id", "source").collect()}
    assert [(s.kind, s.verdict) for s in found[9]] == [("random", "owner_specific")]
    assert [(s.kind, s.verdict, s.n_owners) for s in found[3]] == [("assign", "owner_specific", 1)]
    assert not found[0] and not found[10]
    odd = secrets.find_secrets(docs_of(spark, ODD), "doc_id", "text", "doc_id", "source")
    assert odd.count() == len(ODD)
    assert secrets.find_secrets(docs_of(spark, []), "doc_id", "text", "doc_id", "source").count() == 0


# ---- word shingles ----


def brute_components(rows, words, percent):
    sets = {}
    for key, text in rows:
        w = (text or "").encode().lower().split()
        sets[key] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in sets}


@pytest.mark.parametrize(("words", "percent", "hot"), [(3, 90, 40), (5, 80, 40), (3, 90, 2)])
def test_shingle_components(spark, monkeypatch, words, percent, hot):
    """Chains of edits, copies, a passage that many texts share; also with an order in which nearly all shingles are late."""
    monkeypatch.setattr(shingles, "HOT", hot)
    random = np.random.default_rng(words)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, passage = [], list(random.choice(vocabulary, 40))
    for _ in range(25):
        words_in = list(random.choice(vocabulary, random.integers(30, 90)))
        if random.random() < 0.5:
            words_in += passage
        for _ in range(random.integers(1, 7)):
            rows.append(" ".join(words_in).upper() if random.random() < 0.2 else "  ".join(words_in))
            for _ in range(random.integers(0, 3)):
                words_in[random.integers(len(words_in))] = random.choice(vocabulary)
    rows += [None, "", " \n", "one two", "ONE two", "a b c", "a b"]
    rows = [(int(k), t) for k, t in zip(random.permutation(len(rows)), rows, strict=True)]
    df = docs_of(spark, [(k, t, "en", "s") for k, t in rows])
    found = shingles.similar_documents(df, "doc_id", "text", words, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows, words, percent)


def test_short_texts_that_share_a_frequent_shingle(spark):
    """Texts of 9 and 10 shingles, the first of which very many fronts hold: one list is filled up from beyond its front."""
    known = shingles._WordHashes()
    phrases = [f"p{k} q{k} r{k}" for k in range(5000)]
    phrase = min(phrases, key=lambda p: shingles.shingle_set(p, 3, known)[0])
    rows = []
    for k in range(shingles.HOT + 20):
        text = " ".join([phrase, *(f"w{k}x{i}" for i in range(8))])
        rows += [(2 * k, text), (2 * k + 1, f"{text} more{k}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = shingles.similar_documents(df, "doc_id", "text", 3, 90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows, 3, 90)
    assert all(r.component_id == r.doc_id // 2 * 2 for r in found)


def test_shingles_on_odd_rows(spark):
    found = shingles.similar_documents(docs_of(spark, ODD), "doc_id", "text", 3, 90).collect()
    assert len(found) == len(ODD) and [r.component_id for r in found if r.doc_id is None] == [None]
    assert shingles.similar_documents(docs_of(spark, []), "doc_id", "text", 3, 90).count() == 0


def test_shingle_query(spark, table):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op7_ngram_join"](spark, SF).collect()}
    assert found == brute_components(list(zip(table.doc_id.tolist(), table.text, strict=True)), 3, 90)

def test_half_alike_texts_are_told_apart_before_they_are_pairs(spark, monkeypatch):
    """Texts of one origin, none close enough to another: pairs of them are not written, or all would be."""
    written = []

    def counted(df, name, schema=None):
        table = write_table(df, name, schema)
        if name == "shingle-pairs":
            written.append(table.count())
        return table

    monkeypatch.setattr(shingles, "write_table", counted)
    random = np.random.default_rng(6)
    origin = [f"w{k}" for k in range(120)]
    rows = []
    for key in range(70):
        words = list(origin)
        for k in random.choice(120, 4, replace=False):
            words[k] = f"own{key}x{k}"
        rows.append((key, " ".join(words)))
    rows += [(70, rows[3][1]), (71, f"{rows[4][1]} more")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = shingles.similar_documents(df, "doc_id", "text", 3, 90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows, 3, 90)
    assert sum(written) < 70


def test_long_texts_are_told_apart_before_their_sets_meet(spark, monkeypatch):
    """Sets far larger than a sketch, half alike: the sketches of the join are full, those that grow with the sets are not."""
    written = collections.Counter()

    def counted(df, name, schema=None):
        table = write_table(df, name, schema)
        written[name] += table.count()
        return table

    monkeypatch.setattr(shingles, "write_table", counted)
    origin = [f"w{k}" for k in range(6000)]
    rows = [(key, " ".join([*origin[: 3500 + 30 * key], *(f"own{key}x{k}" for k in range(3500))])) for key in range(12)]
    # of another width of sketch than the text it is a part of: 8,100 and 8,800 shingles
    rows += [(12, " ".join(f"v{k}" for k in range(8102))), (13, " ".join(f"v{k}" for k in range(8802))), (14, f"{rows[3][1]} more")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = shingles.similar_documents(df, "doc_id", "text", 3, 90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows, 3, 90)
    assert written["shingle-pairs"] > 20 and 2 <= written["shingle-close"] < 6


# ---- language-model scores ----


def test_lm_query(spark, table):
    counts, tokens = collections.Counter(), {}
    for key, text in zip(table.doc_id, table.text, strict=True):
        tokens[key] = [*text.encode().lower().split(), b""]
        if crc(key, 7) != 2:
            counts.update(tokens[key])
    n, v = sum(counts.values()), len(counts)
    rows = QUERIES["op1_context_mixing"](spark, SF).toPandas()
    for r in rows.itertuples():
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(own), sum(counts[t] > 0 for t in own), n, crc(r.doc_id, 7) == 2)
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own), rel_tol=1e-9)
    held = rows[rows.held_out]
    assert held.score.sum() / held.n_tokens.sum() > held.base_score.sum() / held.n_tokens.sum() - 0.6
    assert (rows.score < 0).all()


def test_lm_probabilities_add_up():
    """Over all continuations of a byte the mixed bits give probabilities that sum to one."""
    size = len(context_mixing.ORDERS) << context_mixing.SLOT_BITS
    model = context_mixing.Mixer.fresh(np.zeros(size, np.float32), np.zeros(size, np.float32))
    model.learn([b"abc", b"abd", b""], np.array([3.0, 1.0, 2.0]))
    first = [b"" if c == 10 else bytes([c]) for c in range(256) if c != 32]
    ends = model.bits(first)
    word, bit, node, slots = context_mixing.bit_rows([b"%c" % c for c in range(33, 127)])
    assert ends.min() > 0
    stretched, gates = model.inputs(slots)
    _, p, _ = model.probabilities(stretched, gates, node)
    assert ((p > 0) & (p < 1)).all()


def test_lm_on_odd_rows(spark):
    out = context_mixing.score_texts(docs_of(spark, ODD), "doc_id", "text", F.col("doc_id") == 5).toPandas()
    assert len(out) == len(ODD) and (out.score < 0).all() and out.n_tokens.min() == 1
    assert context_mixing.score_texts(docs_of(spark, []), "doc_id", "text", F.lit(False)).count() == 0


# ---- language ----


def test_language_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    found = QUERIES["op2_language"](spark, SF).join(docs, "doc_id").toPandas()
    held = found[found.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.9 and found.score.between(0, 1).all()


def test_language_on_odd_rows(spark):
    train = docs_of(spark, [(i, f"{'the house of words' if i % 2 else 'das Haus der Worte'} {i}", "en" if i % 2 else "de", "s") for i in range(40)])
    model = language.fit(train, "doc_id", "text", "lang")
    out = language.identify(docs_of(spark, [*ODD, (20, "12 34 !?", None, None), (21, "DAS HAUS", None, None)]), "text", model)
    said = {r.doc_id: r.lang_pred for r in out.select("doc_id", "lang_pred", F.col("score")).collect()}
    assert said[1] == said[2] == said[3] == said[20] == "und" and said[21] == "de" and said[4] == "en"
    assert language.fit(docs_of(spark, []), "doc_id", "text", "lang") is None
    assert [r.lang_pred for r in language.identify(docs_of(spark, ODD[:1]), "text", None).collect()] == ["und"]


# ---- toxicity ----


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_is_the_edit_distance():
    random = np.random.default_rng(2)
    for _ in range(1500):
        a, b = ("".join(random.choice(list("ab"), random.integers(0, 7))) for _ in range(2))
        for edits in (1, 2):
            automaton = toxicity.Automaton(a, edits)
            state = automaton.start()
            for letter in b:
                state = automaton.step(state, letter)
            assert automaton.accepts(state) == (distance(a, b) <= edits), (a, b, edits)


def test_lexicon_finds_misspellings():
    lexicon = toxicity.Lexicon(["idiot", "moron"], ["vequ"], innocent=["oron"])
    kinds = {w: lexicon.find(w) for w in ("idiot!", "id1ot", "idioot", "mron", "oron", "vequant", "house", "idiom", "st*pid", "")}
    assert kinds == {"idiot!": 0, "id1ot": 3, "idioot": 3, "mron": 3, "oron": -1, "vequant": 1, "house": -1, "idiom": 3, "st*pid": -1, "": -1}


def toxic_docs(spark):
    random = np.random.default_rng(9)
    words = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(400):
        text = list(random.choice(words, 30))
        if i % 5 == 0:
            text[3:3] = ["you", "blithering"]
        rows.append((i, " ".join(text), "en", "s"))
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    return docs_of(spark, rows), labels


def test_toxicity_learns_and_spares_quotations(spark):
    docs, labels = toxic_docs(spark)
    model = toxicity.fit(docs, "doc_id", "text", labels, "doc_id", "toxic", F.lit(True))
    asked = docs_of(
        spark, [*ODD, (20, "w1 w2 you blithering w5", "en", "s"), (21, "w1 w2 you bl1thering w5", "en", "s"), (22, 'he said "blithering" w3 w4', "en", "s"), (23, "w1 w2 w3", "en", "s")]
    )
    said = {r.doc_id: r.score for r in toxicity.score_texts(asked, "text", model).collect()}
    assert said[20] > 0.5 and said[21] > 0.5 and said[22] < 0.5 and said[23] < 0.5 and said[1] < 0.5
    assert toxicity.score_texts(docs_of(spark, []), "text", model).count() == 0


def test_toxicity_without_labels(spark):
    docs, labels = toxic_docs(spark)
    model = toxicity.fit(docs, "doc_id", "text", labels.limit(0), "doc_id", "toxic", F.lit(True))
    assert toxicity.score_texts(docs, "text", model).agg(F.max("score")).first()[0] < 0.5


# ---- language-model scores: contexts over the word before, mixed along the text ----


def lm_of(texts, words=()):
    size = len(context_mixing.ORDERS) << context_mixing.SLOT_BITS
    model = context_mixing.Mixer.fresh(np.zeros(size, np.float32), np.zeros(size, np.float32))
    codes = context_mixing.Codes(list(words))
    for _ in range(3):
        model.learn_texts([t.encode().split() for t in texts], codes)
    return model, codes


def test_lm_scores_follow_the_word_before():
    """The same words in the order of the training texts are likelier than in another; counts of words cannot tell."""
    pairs = [("salt", "pepper"), ("day", "night"), ("north", "south"), ("left", "right")]
    texts = [" ".join(w for k in range(20) for w in pairs[(i * 7 + k * k) % 4]) for i in range(60)]
    model, codes = lm_of(texts, [w.encode() for p in pairs for w in p] + [b""])
    there, mixed = model.freeze().score([b"day night left right salt pepper".split(), b"day pepper left night salt right".split()], codes)
    assert there > mixed + 1


def test_lm_texts_adapt_on_their_own():
    """A text costs the same whatever stands beside it, and its repetitions less and less."""
    model, codes = lm_of(["a b c d", "b d a c", "c a d b"] * 20, [b"a", b"b", b"c", b"d", b""])
    texts = [b"unheard of words ".split() * n for n in (1, 2, 40)] + [[], b"a b".split(), [b"\xff" * 5000, b"x"]]
    together = model.freeze().score(texts, codes)
    alone = np.concatenate([model.score([t], codes) for t in texts])
    assert np.allclose(together, alone, rtol=1e-6) and (together < 0).all()
    assert together[1] > 2 * together[0] and together[2] / 40 > together[1] / 2


def test_lm_codes_are_read_again():
    """No coded word begins another one, and the mixed bits of all bytes sum to one."""
    words = [b"%x" % k for k in range(context_mixing.SHORT + context_mixing.MIDDLE + 70_000)]
    codes = context_mixing.Codes(words)
    coded = sorted([*codes.values(), codes[b"spelled"], codes[b"spell"], codes[b""]])
    assert len(set(coded)) == len(words) + 3 and not any(b.startswith(a) for a, b in zip(coded, coded[1:], strict=False))
    model, codes = lm_of(["abc abd", "abc"])
    byte, _, contexts = context_mixing.contexts_of([bytes([c]) for c in range(256)], np.arange(256))
    bit, node, slots = context_mixing.bits_of(byte, contexts)
    _, p, _ = model.probabilities(*model.inputs(slots), node)
    assert math.isclose(np.abs(bit - (1 - p)).prod(axis=1, dtype=float).sum(), 1, rel_tol=1e-4)


def test_lm_bits_of_half_a_byte_lie_side_by_side():
    """What a step looks up is bounded: for each predictor two runs of 16 slots a byte."""
    byte, _, contexts = context_mixing.contexts_of([b"some", b"words", b"some"], np.array([0]))
    _, _, slots = context_mixing.bits_of(byte, contexts)
    runs = (slots >> 4).reshape(len(context_mixing.ORDERS), len(byte), 2, 4)
    assert (runs == runs[..., :1]).all() and (slots[0, :4] == slots[0, 9:]).all()


def test_lm_spells_frequent_pairs_as_one():
    """Unknown words take fewer bytes where they are made of what the dictionary's are made of, and can be read again."""
    codes = context_mixing.Codes([b"nation", b"station", b"ration", b"motion", b"na!n", b"\xc3\xa9t\xc3\xa9"])
    words = [b"lotion", b"nationstation", b"\xc3\xa9t", b"zzz", b"q", b"", b"an", b"na"]
    spelled = [codes[w] for w in words]
    assert codes.coded([*words, b"motion"]) == [*spelled, codes[b"motion"]]
    assert len(spelled[1]) < len(words[1]) / 2 + 2 and spelled[3] == b"\xffzzz "
    for word, x in zip(words, spelled, strict=True):
        for pair, free in reversed(codes.pairs):
            x = x.replace(free, pair)
        assert x == b"\xff" + word + b" "


def test_lm_counts_add_up():
    """Sums over tasks are exact, and where they pass what a slot holds the share of ones stays."""
    size = context_mixing._ONE
    used, counts = np.array([3, 7], "<u2").tobytes(), np.array([5 * size + 2, (1 << 30) * size + (1 << 28)]).tobytes()
    rows = pa.RecordBatch.from_pydict({"part": pa.array([1] * 3, pa.int32()), "used": [used] * 3, "x": [counts] * 3})
    (batch,) = context_mixing._added((pa.scalar(1),), iter([rows]))
    added = np.frombuffer(batch.column("x")[0].as_py(), np.int64)
    assert (added[3] >> 32, added[3] & (size - 1), added[0]) == (15, 6, 0)
    assert (added[7] >> 32, added[7] & (size - 1)) == (1 << 30, 1 << 28)


def test_lm_ranks_are_read_off_codes():
    words = [b"%x" % k for k in range(context_mixing.SHORT + context_mixing.MIDDLE + 70_000)]
    coded = context_mixing.Codes(words).coded([*words, b"spelled", b"", b"z"])
    lengths = np.array([len(x) for x in coded])
    ranks = context_mixing.ranks_of(np.frombuffer(b"".join(coded), np.uint8), np.cumsum(lengths) - lengths, lengths)
    assert ranks.tolist() == [*range(len(words)), -1, -1, -1]


def test_lm_travels_as_it_is():
    """A model that was sent to a task scores as the one that was learned."""
    model, codes = lm_of(["salt pepper salt", "day night"] * 10, [b"salt", b"pepper", b""])
    sent = pickle.loads(pickle.dumps(model.freeze()))
    texts = [b"salt pepper night".split(), []]
    assert np.array_equal(sent.score(texts, codes), model.score(texts, codes))
