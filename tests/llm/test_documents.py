"""Language, personal data, toxicity, licences and quality: against brute force or held-out rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import rows

from benthoframe.llm import fertility, language_id, licenses, pii, toxicity
from benthoframe.llm.queries import QUERIES, vocabulary
from benthoframe.llm.tables import fold
from tests.llm.conftest import SF


def test_trigram_counts():
    texts = ["Añb, cd", "", "12 3", "x" * 50]
    owner, bucket, n = language_id.bucket_counts(texts)
    assert np.bincount(owner, n, 4).tolist() == [5, 0, 0, 50]
    language_id._SPAN, kept = 7, language_id._SPAN
    try:
        assert [x.tolist() for x in language_id.bucket_counts(texts)] == [owner.tolist(), bucket.tolist(), n.tolist()]
    finally:
        language_id._SPAN = kept


def test_mixture_of_two_languages():
    p = np.array([[0.9, 0.05, 0.05], [0.05, 0.9, 0.05], [0.05, 0.05, 0.9]])
    owner, bucket = np.repeat([0, 1], 3), np.tile([0, 1, 2], 2)
    n = np.array([600, 400, 1, 1000, 1, 1])
    keep = n > 1
    share = language_id.mixtures(owner[keep], n[keep], p[bucket[keep]], 2)
    plain = np.full(3, 1 / 3)
    for _ in range(200):  # EM written out
        w = plain * p[:2]
        plain = (np.array([600, 400]) / w.sum(1) @ w) / 1000
    assert np.allclose(share[0, :2], plain[:2], atol=0.02) and share[0, 2] == 0
    assert share[1].tolist() == [1, 0, 0]


def test_language_of_held_out_documents(spark, docs, odd, empty):
    lang = {r.doc_id: r.lang for r in docs.collect()}
    found = QUERIES["op1_language_mixture"](spark, SF).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == len(lang) and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    model = language_id.train(docs, fold("doc_id", 3) != 1)
    strange = language_id.identify(odd, *model).collect()
    assert {r.doc_id: r.lang_pred for r in strange if r.doc_id in (1, 2, 3)} == dict.fromkeys((1, 2, 3), "und")
    assert len(strange) == 10 and language_id.identify(empty, *model).count() == 0
    nothing = language_id.train(empty, fold("doc_id", 3) != 1)
    assert {r.lang_pred for r in language_id.identify(odd, *nothing).collect()} == {"und"}


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
            if {"email": True, "ip": kind == "ip" and max(map(int, m[0].split("."))) <= 255, "card": 13 <= len(digits) <= 19 and total % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.fixture(scope="module")
def field(spark):
    return pii.train_field(pii.labelled_table(spark))


def test_base_spans_match_the_patterns():
    rng = random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choice("aZ@.@.0912+-() %é\n@.05") for _ in range(rng.randint(0, 50)))
        assert pii.base_spans(text) == plain_spans(text), text
    pii.base_spans("1" * 200_000 + "a" * 200_000 + "@" * 1000)  # linear


def test_field_learns_the_table():
    def sentences(n, seed):
        out = {}
        for s, _, token, tag in pii.labelled_tokens(n, seed):
            tokens, tags = out.setdefault(s, ([], []))
            tokens.append(token)
            tags.append(tag)
        return list(out.values())

    field = pii.Field().train(sentences(250, 7))
    right = total = 0
    for tokens, tags in sentences(100, 99):
        found = [field.tags[t] for t in field.viterbi(field.emissions(tokens, None, None)[None])[0]]
        right += sum(map(str.__eq__, found, tags))
        total += len(tags)
    assert right / total > 0.97
    # best of all tag sequences
    tokens = ["call", "(555)", "123-4567"]
    e, step, s = field.emissions(tokens, None, None), field.step + field.allowed, len(field.tags)
    best = max(((step[0, a] + e[0, a] + step[a, b] + e[1, b] + step[b, c] + e[2, c] + step[c, 0], (a, b, c)) for a in range(s) for b in range(s) for c in range(s)))
    assert tuple(field.viterbi(e[None])[0]) == best[1]
    spans = pii.find_spans(["call (555) 123-4567 now"], field)[0]
    assert spans == ([], [("phone", 5, 19)])
    assert pii.redacted("call (555) 123-4567 now", spans[1]) == "call <PHONE> now"


def test_long_runs_in_parts(field):
    rng = random.Random(5)
    made = [f"{rng.randint(100, 999)}", "12", "(555)", "123-4567", "+49", "a1b2c3d4e5f6a7b8c9d0", "4111", "1111", "x@y", "3.4", "@me"]
    for size in (2, 3, 7, 50):
        for _ in range(30):
            texts = ["".join(rng.choice(made) + rng.choice([" ", "\n"]) for _ in range(rng.randint(1, 80))) + rng.choice(["", "end"]) for _ in range(3)]
            whole = [sorted(x) for x in pii.field_spans(texts, field)]
            assert [sorted(x) for x in pii.field_spans(texts, field, most=size, hold=20)] == whole
    long = pii._LongRun("1 " * 30_000, field)
    for part, _ in pii._runs(long.text):
        long.add(part)
    assert len(long.parts) == 8 and long.spans() == []


def test_secrets_of_letters(field):
    rng = random.Random(6)
    key = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(n))
    texts = [f"the token = {key(rng.randint(20, 40))} was given" for _ in range(300)]
    found = pii.field_spans(texts, field)
    assert sum([k for k, _, _ in x] == ["secret"] for x in found) >= 270
    plain = ["eine Donaudampfschifffahrtsgesellschaft", "internationalization and counterrevolutionaries", "INTERNATIONALIZATIONS", "x" * 300, "getElementsByTagNames"]
    assert pii.field_spans(plain, field) == [[]] * 5


def test_pii_query(spark, docs, odd, empty):
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = QUERIES["op2_pii"](spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        base = plain_spans(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in base) for x in PLAIN)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert {f"{k}:{s}:{e}" for k, s, e in base} <= set(r.spans.split(","))
    field = pii.train_field(pii.labelled_table(spark))
    strange = {r.doc_id: r for r in pii.find_pii(odd, field).collect()}
    assert strange[7].spans == "email:13:19,ip:20:27" and strange[1].redacted_text is None and strange[2].spans == ""
    assert pii.find_pii(empty, field).count() == 0


def test_label_model_finds_wrong_labels():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.1
    fires = np.stack([np.where(truth, rng.random(4000) < 0.5, rng.random(4000) < 0.002) for _ in range(8)], 1)
    gold = np.where(rng.random(4000) < 0.05, ~truth, truth).astype(float)
    q, rate, share = toxicity.label_model(fires, gold)
    assert ((q > 0.5) == truth).mean() > 0.99 and abs(rate[1] - 0.5).max() < 0.08
    twice = toxicity.label_model(np.column_stack([fires, fires[:, :1]]), gold)[2]
    assert twice[0] < 0.6 < share[0] and twice[-1] < 0.6  # a voter and its copy share one vote


def test_linear_model_fits():
    rng = np.random.default_rng(4)
    x = rng.random((800, 6)) < 0.4
    q = 1 / (1 + np.exp(-(x @ np.array([3.0, -2, 0, 0, 0, 0]) - 0.5)))
    owner, sign = np.nonzero(x)
    w, b = toxicity.fit_linear(owner, sign, q, 6, l1=1e-5)
    assert np.allclose(w[:2], [3, -2], atol=0.3) and abs(w[2:]).max() < 0.2 and abs(b + 0.5) < 0.2


def test_voters_that_no_label_chooses(spark):
    """Voters of the lexicon and the patterns outvote wrong labels, also for words that the labels never showed."""
    rng = np.random.default_rng(8)
    insults = ["idiot", "loser", "scum", "pathetic", "clown", "vermin"]
    rows, truth, gold = [], [], []
    for i in range(3000):
        bad = rng.random() < 0.15
        words = [f"w{k}" for k in rng.integers(0, 400, 30)] + ([str(w) for w in rng.choice(insults, 2, replace=False)] if bad else [])
        rows.append((i, " ".join(words) + ("! !" if bad and rng.random() < 0.4 else "")))
        truth.append(bad)
        gold.append((i, int(bad != (rng.random() < 0.08))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(gold, "doc_id long, toxic int"))
    assert {" mind", " worth", " filth", " mockery", " several", " exclaims"} <= model.voters.keys()
    assert np.mean([(model.score(t) >= 0.5) == y for (_, t), y in zip(rows, truth)]) > 0.99
    assert toxicity.signs("You are an idiot, sh*t, m0ron! SHUT YOUR MOUTH") >= {" addresses", " mind", " stars", " digits", " silences", " shouts"}
    assert not {x for x in toxicity.signs("a loser? moron 1 youth") if x in (" digits", " addresses", " stars")}


def test_toxicity_of_held_out_documents(spark, docs, odd, empty):
    sf = SF.replace("0.001", "0.01")
    known = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = QUERIES["op3_toxicity"](spark, sf).collect()
    held = [r for r in found if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in held) >= 0.93 * len(held)  # a part of the labels is wrong
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    none = toxicity.train(odd, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int"))
    scores = toxicity.score(odd, none).collect()
    assert len(scores) == 10 and {r.score for r in scores} == {0.5}
    assert toxicity.score(empty, none).count() == 0


def test_licenses(spark, docs, odd, empty):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in QUERIES["op8_licenses"](spark, SF).collect():
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id]))
        at = [(i, v) for k, v in phrases.items() for i in range(len(words)) if words[i : i + len(k.split())] == k.split()]
        places = [i for i, _ in at]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(at), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted({v for _, v in at})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    assert [r.n_words for r in licenses.scan_licenses(odd.where("doc_id in (1, 2, 3)")).collect()] == [0, 0, 0]
    assert licenses.scan_licenses(empty).count() == 0


def test_matching_statistics():
    rng = random.Random(5)
    templates = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 14))] for _ in range(5)]
    automaton = licenses.Automaton(templates)
    parts = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(25)]
        longest = [max((k for k in range(e + 1) if k == 0 or tuple(words[e - k : e]) in parts)) for e in range(26)]
        want = [(e, longest[e]) for e in range(1, 26) if longest[e] >= 2 and (e == 25 or longest[e + 1] <= longest[e])]
        found = automaton.matches(words, 2)
        assert [(e, n) for e, n, _ in found] == want
        for e, n, state in found:
            for t, ends in automaton.ends[state].items():
                assert all(templates[t][x - n : x] == words[e - n : e] for x in ends)
    mit = dict(licenses.TEMPLATES)["isc"]
    changed = mit.replace("modify", "alter").replace("granted", "given")
    assert "isc" in licenses.Scanner().scan(f"Some words. {changed} More words.")[5].split(",")


def plain_chain(found, template):
    """The best chain by trying all; ties by any."""
    best = 0

    def go(at, before, end, covered, first):
        nonlocal best
        best = max(best, covered)
        for i in range(at, len(found)):
            text_end, template_end, size = found[i]
            fresh = min(size, template_end - before, text_end - end)
            if fresh > 0 and text_end - first <= 2 * template:
                go(i + 1, template_end, text_end, covered + fresh, first)

    for i, (text_end, template_end, size) in enumerate(found):
        go(i + 1, template_end, text_end, size, text_end - size)
    return best


def test_best_chain_is_the_best():
    rng = random.Random(12)
    for _ in range(3000):
        template = rng.randint(3, 14)
        found = sorted({(rng.randint(3, 40), rng.randint(1, template), 0) for _ in range(rng.randint(1, 9))})
        found = [(a, b, rng.randint(1, min(a, b))) for a, b, _ in found]
        covered, first, end = licenses.best_chain(found, template)
        assert covered == plain_chain(found, template) and 0 <= first < end and end - first <= 2 * template


def test_licenses_of_own_templates(spark, odd, empty):
    whole = " ".join(f"clause{i} of the own licence" for i in range(40))
    texts = [whole, "before " + " ".join(w if i % 23 else "changed" for i, w in enumerate(whole.split())) + " behind", whole[: len(whole) // 2], None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.scan_licenses(df, {}, [("own", whole)]).collect()}
    assert [rows[i].labels for i in range(4)] == ["own", "own", "", ""]
    assert rows[0].score == 1 and rows[0].spans[0].asDict() == {"label": "own", "covered": 1.0, "first": 0, "end": 200}
    assert 0.4 < rows[2].score < 0.6 and rows[3].score == 0
    found = licenses.scan_licenses(odd).collect()
    assert len(found) == 10 and {r.labels for r in found} == {""} and {r.score for r in found if r.doc_id in (1, 2, 3)} == {0.0}


def test_fertility(spark, docs, odd, empty):
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = QUERIES["op9_fertility"](spark, SF).collect()
    for r in found:
        text = texts[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        real = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(real) - len(set(real)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (r.kept and r.base_failed)
    passed = [r for r in found if not r.base_failed]
    assert sum(r.kept for r in passed) > 0.97 * len(passed)
    model = vocabulary("piece_bpe_32k.model")
    junk = spark.createDataFrame([(1000 + i, "ⴰⵣⵓⵍ ⵎⵏⵉ " * 30 + " ".join(map(str, range(100))), "en") for i in range(2)], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in fertility.judge(docs.select("doc_id", "text", "lang").unionByName(junk), model).collect()}
    assert not kept[1000]
    strange = {r.doc_id: r for r in fertility.judge(odd, model).collect()}
    assert strange[1].base_failed and strange[1].entropy is None and strange[8].n_repeat_words == 180
    assert fertility.judge(empty, model).count() == 0
    assert len(rows(fertility.measure(odd.where("doc_id = 5"), model))) == 1


def test_fertility_measures(spark):
    from sentencepiece import SentencePieceProcessor

    path = vocabulary("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    texts = ["The quick brown fox, the quick brown fox.", "ⴰⵣⵓⵍ x ⵎⵏⵉ", "Straße 日本 12.5%", "a"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for r in fertility.measure(docs, path).collect():
        ids = model.encode(texts[r.doc_id])  # single-spaced, so its ids are those of its words
        n = Counter(ids)
        entropy = -sum(c / len(ids) * np.log2(c / len(ids)) for c in n.values())
        assert r.chars_per_token == pytest.approx(len(texts[r.doc_id].replace(" ", "")) / len(ids))
        assert r.byte_share == pytest.approx(sum(model.id_to_piece(i).startswith("<0x") for i in ids) / len(ids))
        assert r.entropy == pytest.approx(entropy, abs=1e-9)


def test_toxicity_is_not_taken_for_a_language(spark):
    """Function words that are a little more common among toxic texts are no voters, however many texts show it."""
    rng = np.random.default_rng(1)
    rows, toxic = [], []
    for i in range(6000):
        english = rng.random() < 0.5
        bad = rng.random() < (0.13 if english else 0.08)
        words = [f"{'e' if english else 'f'}{k}x" for k in np.flatnonzero(rng.random(80) < 0.7)]
        words += [f"bad{k}x" for k in rng.choice(20, 3)] if bad else []
        rows.append((i, " ".join(words)))
        toxic.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    model = toxicity.train(docs, spark.createDataFrame(toxic, "doc_id long, toxic int"))
    found = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    assert not [v for v in model.voters if v.startswith(("e", "f"))]
    assert np.mean([found[i] == y for i, y in toxic]) > 0.98


def test_small_languages_are_judged(spark, docs):
    model = vocabulary("piece_bpe_32k.model")
    junk = "ⴰⵣⵓⵍ ⵎⵏⵉ " * 30 + " ".join(map(str, range(100)))
    small = spark.createDataFrame([(1000, junk, "zz"), (1001, junk, None)], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in fertility.judge(docs.select("doc_id", "text", "lang").unionByName(small), model).collect()}
    assert not found[1000].base_failed and not found[1000].kept and not found[1001].kept
    assert all(r.kept for r in fertility.judge(small, model).collect())
