"""PII, quality rules, fingerprints and toxicity."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from appendlog.llm import minhash, pii, quality, toxicity

from .texts import corpus, prose

ROWS = corpus()
GRAMMARS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def by_regex(text):
    out = []
    for k, (kind, p) in enumerate(GRAMMARS.items()):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card":
                d = [int(c) for c in digits[::-1]]
                if not 14 <= len(d) <= 19 or (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, kind, m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


def test_base_spans_equal_the_grammars_on_random_texts():
    rng = random.Random(11)
    parts = ["a@b.c", "@", "x.y@z", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "+1 (555) 123-4567", "+", "4539578763621486",
             "4539 5787 6362 1486", "12", ".", "-", " ", "é", "@a.b", "a@b@c.d", "+12345678901", "007.008.009.010", "1..2", "\n"]
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))
        assert [s for s in pii.find_spans(t) if s[0] in pii.BASE_KINDS] == by_regex(t), t


def test_addresses_of_very_many_digits():
    zeros = "0" * 5000
    t = f"at {zeros}.1.2.3 and {zeros}1.{zeros}.0.255 and {'9' * 5000}.1.2.3"
    ips = [t[s:e] for k, s, e in pii.find_spans(t) if k == "ip"]
    assert ips == [f"{zeros}.1.2.3", f"{zeros}1.{zeros}.0.255"]


def test_added_kinds():
    t = 'password=abc12345x token = "0a1b2c3d4e5f" IBAN GB82 WEST 1234 5698 7654 32 ssn 123-45-6789 http://me@host/x http://example.com'
    found = {(k, t[s:e]) for k, s, e in pii.find_spans(t)}
    assert {("secret", "abc12345x"), ("secret", "0a1b2c3d4e5f"), ("iban", "GB82 WEST 1234 5698 7654 32"),
            ("ssn", "123-45-6789")} <= found
    assert [k for k, _ in found].count("url") == 1
    assert pii.find_spans("The password is a secret token of the account.") == []


def test_report_and_redact(table):
    rows = ROWS + [(5000, "mail a.b@c.de or 10.0.0.1, 4539578763621486"), (5000, "mail a.b@c.de or 10.0.0.1, 4539578763621486")]
    got = pii.report(table(rows)).where("doc_id = 5000").collect()
    spans = by_regex(rows[-1][1])
    assert len(got) == 2 and all(r.base_sha256 == hashlib.sha256(pii.digest(spans).encode()).hexdigest() for r in got)
    assert (got[0].n_email, got[0].n_ip, got[0].n_card, got[0].n_phone) == (1, 1, 1, 0)
    out = pii.redact(table(rows, ["spans"]))
    assert out.columns[-1] == "spans"
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[5000] == "mail [EMAIL] or [IP], [CARD]"
    assert all(texts[i] == t for i, t in ROWS)
    kept = pii.detect(table(rows, ["spans"])).where("doc_id = 5000").first()
    assert [(s.kind, s.start, s.end) for s in kept.spans] == spans
    assert pii.report(table([])).count() == 0


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_facts(text):
    w = WORD.findall(text or "")
    c = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    under = {j for i in range(len(w) - 4) if c[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text or ""), len(lines) - len(set(lines)), len(under))


def test_quality_statistics(table):
    rng = random.Random(2)
    rows = ROWS + [(3000 + k, " ".join(rng.choice("ab|c") + rng.choice("\n \t") for _ in range(40))) for k in range(30)]
    got = quality.score(table(rows, ["n_words", "kept"])).collect()
    want = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        facts = word_facts(want[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == facts
        assert r.base_failed == (facts[0] < 10 or 100 * facts[4] > 20 * facts[0])
        assert not (r.base_failed and r.kept)


def junk(rng, k):
    w = prose(rng, 80).split()
    return [" ".join(x + "!!" for x in w).upper(), " | ".join(w), " ".join(x + "%%%" for x in w)][k % 3]


def test_quality_verdicts(table):
    rng = random.Random(8)
    good = [(i, prose(rng, rng.randint(40, 150))) for i in range(120)]
    bad = [(500 + k, junk(rng, k)) for k in range(21)]
    verdict = {r.doc_id: r.kept for r in quality.score(table(good + bad)).collect()}
    assert all(verdict[i] for i, _ in good) and not any(verdict[i] for i, _ in bad)
    kept = quality.keep_good(table(good + bad + [(1, None)], ["kept"]))
    assert kept.columns[-1] == "kept" and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in good)
    assert quality.score(table([])).count() == 0 and quality.keep_good(table([])).count() == 0


def test_fit_counts_every_row(spark):
    votes = spark.createDataFrame([(1, -1)] * 30 + [(1, 1)] * 300 + [(-1, -1)] * 20, "a int, b int")
    prior, w = quality.fit(votes, ["a", "b"])
    assert prior > 0 and w["b", -1] < 0 < w["b", 1] and w["a", 0] == 0.0


def python_fingerprint_set(text):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def edits(spark):
    from .conftest import SCHEMA

    df = spark.createDataFrame([(i, t, None, "s", 0) for i, t in ROWS], SCHEMA).repartition(4)
    old, minhash.BUCKET_BYTES = minhash.BUCKET_BYTES, 3000
    try:
        return {r.doc_id: r for r in minhash.compare_edits(df).collect()}
    finally:
        minhash.BUCKET_BYTES = old


def test_edited_texts(edits):
    order = sorted(ROWS)
    assert len(edits) == len(ROWS)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        t, nxt = t or "", nxt or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert edits[i].n_chars == len(t)
        assert edits[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest(), i


def test_likeness_follows_the_shingles(edits):
    order, errors = sorted(ROWS), []
    for (i, t), (j, nxt) in zip(order, order[1:] + order[:1], strict=True):
        for other, near in ((nxt, edits[i].near_next),):
            a, b = python_fingerprint_set(t), python_fingerprint_set(other)
            exact = len(a & b) / len(a | b) if a | b else 1.0
            errors.append(abs(near - exact))
        half = len(t or "") // 2
        a = python_fingerprint_set(t)
        b = python_fingerprint_set((t or "")[:len(t or "") - half] + (nxt or "")[:half])
        errors.append(abs(edits[i].near_edited - (len(a & b) / len(a | b) if a | b else 1.0)))
        assert (t == nxt) <= (edits[i].fingerprint == edits[j].fingerprint)
    assert sum(errors) / len(errors) < 0.05 and max(errors) < 0.3


def test_fingerprints_of_equal_and_odd_texts(spark, edits):
    by_text: dict = {}
    for i, t in ROWS:
        by_text.setdefault(t or "", set()).add(edits[i].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert by_text[""] == {""} and len(next(iter(by_text["word"]))) == minhash.BINS * minhash.BITS // 4
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.compare_edits(none).count() == 0
    one = spark.createDataFrame([(4, "a b c d e f")], "doc_id long, text string")
    r = minhash.compare_edits(one).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"a b c a b c"[:6] + b"a b c").hexdigest()


INSULTS = ["idiotic", "worthless", "pathetic"]


@pytest.fixture(scope="module")
def toxic(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        t, bad = prose(rng, rng.randint(30, 80)), i % 8 == 0
        if bad:
            w = t.split(" ")
            w[10:10] = rng.sample(INSULTS, 2)
            t = " ".join(w)
        rows.append((i, t))
        labels.append((i, int(bad)))
    rows += [(1000, None), (1001, ""), (1002, "they are p4th3t1c and w0rthle$$ people today"),
             (1003, "so p a t h e t i c and iiidiooootic really"), (1004, "call 555 0199 at 10:30, room b12")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return rows, dict(labels), docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(toxic):
    rows, labels, docs, frame = toxic
    got = {r.doc_id: r for r in toxicity.score(docs, frame).collect()}
    assert len(got) == len(rows)
    for i, y in labels.items():
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i].predicted == int(got[i].score >= 0.3)
    held = [i for i in labels if got[i].held_out]
    assert sum(got[i].predicted == labels[i] for i in held) / len(held) > 0.95
    assert got[1000].predicted == got[1001].predicted == got[1004].predicted == 0
    assert got[1002].predicted == got[1003].predicted == 1


def test_held_out_labels_teach_nothing(toxic):
    _, labels, docs, frame = toxic
    turned = frame.withColumn("toxic", F.when(toxicity.held_out(frame.doc_id), 1 - frame.toxic).otherwise(frame.toxic))
    model = toxicity.language_model(docs)
    assert toxicity.fit(docs, frame, model) == toxicity.fit(docs, turned, model)
    assert toxicity.fit(docs, frame.where("false"), model) == {}
    assert toxicity.score(docs.where("false"), frame).count() == 0


def test_restored_words(toxic):
    _, _, docs, _ = toxic
    model = toxicity.language_model(docs)
    assert "pathetic" in toxicity.restore("p4th3t1c", model)
    assert "worthless" in toxicity.restore("w.o.r.t.h.l.e.s.s", model)
    assert "idiotic" in toxicity.restore("iiidiooootic", model)
    assert toxicity.restore("", model) == []


def test_training_rows_with_a_common_passage_all_count(spark):
    rng = random.Random(14)
    passage = " ".join(f"clause{k}" for k in range(60))
    # one passage in every text; the toxic ones hold the insult too
    rows = [(i, f"{prose(rng, 4)} {passage} {prose(rng, 4)}" + (" blockhead" if i % 4 == 0 else "")) for i in range(160)]
    labels = [(i, int(i % 4 == 0)) for i, _ in rows]
    rows += [(1000 + i, t) for i, t in rows[:40]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, frame, toxicity.language_model(docs))
    assert "blockhead" in lexicon and not any(f.startswith("clau") for f in lexicon)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, frame).collect()}
    assert all(got[i] == y and got.get(1000 + i, y) == y for i, y in labels)


def test_obfuscated_tokens_are_read(spark, toxic):
    _, _, docs, _ = toxic
    plain = spark.createDataFrame([(k, "an idiot, a clown, scum; stupid asses pass") for k in range(40)], "doc_id long, text string")
    reader = toxicity.Reader(toxicity.language_model(docs.union(plain)))
    marks = {"idiot": 7.0, "idio-": 6.0, "stup-": 6.0, "clown": 7.0, "scum": 7.0, "ass": 7.0}
    for t in ("!diot", "|diot", "|diot!", "!diot,", "stup*", "(lown", "((lown)", "4$$", "@$$", "a$$", "s c u m", "s ( u m", "s.(.u.m",
              "( l o w n", "a $ $", "a s s", "iddiott", "iddiot.", "idiot", "idiot!", "s c * m"):
        assert toxicity.text_score(f"you are {t} today", reader, marks) >= 0.3, t
    once = toxicity.text_score("you idiot today", reader, marks)
    for t in ("you idiot! today", "you !diot idiot today", "(idiot)"):
        assert toxicity.text_score(t, reader, marks) == pytest.approx(once, abs=1e-3), t
    for t in ("a still letter", "in 1990 and 2010 (maybe) 1 2 3", "wait! *now* | a | b | c |", "10:30 b12 555 0199"):
        assert toxicity.text_score(t, reader, marks) < 0.3, t


def xx(value, seed):
    """Spark's xxhash64 of one value under a seed."""
    import struct

    import xxhash

    raw = value.encode() if isinstance(value, str) else struct.pack("<i" if isinstance(value, int) and -2**31 <= value < 2**31 else "<q", value)
    return xxhash.xxh64_intdigest(raw, seed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def xx_long(value, seed):
    import struct

    import xxhash

    return xxhash.xxh64_intdigest(struct.pack("<q", value), seed)


def plain_fingerprint(text):
    """Bins, densification and digits by plain loops."""
    words = WORD.findall(text or "")
    if not words:
        return ""
    bins = [None] * minhash.BINS
    for i in range(max(1, len(words) - 4)):
        h = 42
        for w in words[i:i + 5]:
            h = xx(w, h)
        b = h >> (64 - 7)
        if bins[b] is None or h < bins[b]:
            bins[b] = h
    out = ""
    for b in range(minhash.BINS):
        v = bins[b]
        for t in range(minhash.PROBES[1]):
            if v is not None:
                break
            v = bins[signed(xx(t, xx(b, 42))) % minhash.BINS]
        if v is None:
            v = next(x for x in bins[b:] + bins if x is not None)
        out += "%x" % (xx(b, xx_long(signed(v), 42)) & 15)
    return out


def test_fingerprints_equal_plain_loops(edits):
    for i, t in ROWS:
        assert edits[i].fingerprint == plain_fingerprint(t), i


def test_fingerprints_of_few_shingles(spark):
    """Distinct one-word texts have fingerprints of their own, and likeness is
    near the truth for sets of any size."""
    one = spark.createDataFrame([(i, f"word{i}") for i in range(2000)], "doc_id long, text string")
    got = minhash.with_fingerprint(one, "text", "f").select("f").distinct().count()
    assert got == 2000
    rng = random.Random(12)
    rows, exact = [], {}
    for size in (1, 2, 5, 20):
        for k in range(60):
            a = [f"w{rng.getrandbits(30)}" for _ in range(size + 4)]
            shared = rng.randint(0, size)
            b = a[:shared + 4] + [f"w{rng.getrandbits(30)}" for _ in range(size - shared)] if shared else [
                f"w{rng.getrandbits(30)}" for _ in range(size + 4)]
            x, y = " ".join(a), " ".join(b)
            s, t = python_fingerprint_set(x), python_fingerprint_set(y)
            rows.append((len(rows), size, x, y))
            exact[len(rows) - 1] = len(s & t) / len(s | t)
    df = spark.createDataFrame(rows, "k long, size int, a string, b string")
    df = minhash.with_fingerprint(minhash.with_fingerprint(df, "a", "fa"), "b", "fb")
    near = df.select("k", "size", minhash.likeness(F.col("fa"), F.col("fb")).alias("near")).collect()
    for size in (1, 2, 5, 20):
        errors = [abs(r.near - exact[r.k]) for r in near if r.size == size]
        assert sum(errors) / len(errors) < 0.06, (size, sum(errors) / len(errors))


def test_viterbi_equals_exhaustive_paths(toxic):
    """The best reading of a token is the cheapest of all paths through its lattice."""
    import itertools

    _, _, docs, _ = toxic
    model = toxicity.language_model(docs)

    def cost(word, channel):
        x = y = 0
        c = channel
        for ch in word + "\0":
            code = int(toxicity._CODE[ord(ch)]) if 0 < ord(ch) < 256 else 0
            c -= float(model[(x * toxicity.SIDE + y) * toxicity.SIDE + code])
            x, y = y, code
        return c

    for token in ("p4th3t1c", "w0rthle$$", "i.d.i.o.t", "lett3r", "ss++1", "st*ne", "a@b", "77", "iidiott", "br3@d!"):
        paths = [("".join(r[0] for r in p), sum(r[1] for r in p)) for p in itertools.product(*toxicity._lattice(token))]
        best = min(cost(w, c) for w, c in paths if w)
        got = toxicity.restore(token, model)[0]
        assert min(cost(w, c) for w, c in paths if w == got) == pytest.approx(best, abs=1e-3), token


def test_plain_words_are_skipped_without_loss(toxic):
    """A scorer that restores every odd token gives the same scores."""
    rows, _, docs, frame = toxic
    model = toxicity.language_model(docs)
    lexicon = toxicity.fit(docs, frame, model)
    lexicon.update({"leter": 3.0, "pas-": 4.0, "coffe-": 3.0})
    reader = toxicity.Reader(model)

    class Every(toxicity.Scorer):
        def _reaches(self, word):
            return True

    rng = random.Random(3)
    texts = [t for _, t in rows[:80]]
    texts += [" ".join(rng.choice(["letter", "leetter", "passs", "coffee,", "bookkeeper", "pathhetic", "p4th3tic", "i d i o t", "a.b.c"])
                       for _ in range(12)) for _ in range(60)]
    quick, every = toxicity.Scorer(reader, lexicon), Every(reader, lexicon)
    assert [quick.score(t) for t in texts] == [every.score(t) for t in texts]


def test_quick_test_of_spelled_words():
    rng = random.Random(6)
    for _ in range(20_000):
        low = "".join(rng.choice("ab1é  ..-_*@!x?\n") for _ in range(rng.randint(0, 24)))
        want = {"".join(unit.findall(m.group())) for pattern, unit in toxicity._SPELLED for m in pattern.finditer(low)}
        assert toxicity.spelled(low) == want, repr(low)
