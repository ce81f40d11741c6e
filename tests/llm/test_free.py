"""The operators with Python parts, against brute force."""

import hashlib
import io
import random
import re
import zlib

import numpy as np
import pytest
import zstandard

from timeline_engine.llm import components, hilbert_pack, html_crf, parity_join, pu_toxicity, quality_rules, warc_dict, winnowing
from timeline_engine.llm.common import word_hashes

RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 7))) for _ in range(400)]
HARD = [None, "", " \n\t ", "one", "one two three four", "A b C d E", "a b c d e f", "z " * 6000, "tab\tnew\x0bline\x0cff\rcr", "é É ß nb ls 日本 語"]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(text, share, rng=RNG):
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text.split())


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", 3, b"q") for i, t in zip(ids, texts, strict=True)], "doc_id bigint, text string, source string, n int, blob binary")


def copies():
    rng, out = random.Random(9), list(HARD) * 2
    for n in (5, 6, 8, 12, 20, 40, 80, 200, 500):
        base = prose(n, rng)
        out += [base, base.upper(), "\t" + base.replace(" ", "\n")] + [edited(base, s, rng) for s in (0.01, 0.02, 0.03, 0.05, 0.1) for _ in range(4)]
        out += [base + " " + prose(max(1, n // k), rng) for k in (3, 4, 5, 10)]
    passage = prose(60, rng)
    out += [prose(rng.randint(1, 60), rng) + " " + passage + " " + prose(rng.randint(1, 60), rng) for _ in range(60)]
    rng.shuffle(out)
    return out


def shingles(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard_brute(texts):
    sets, top = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return [(i, len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("frequent", [16, 1])
def test_jaccard_join(spark, monkeypatch, frequent):
    monkeypatch.setattr(parity_join, "FREQUENT", frequent)
    texts = copies()
    got = sorted(tuple(r) for r in parity_join.jaccard_components(frame(spark, texts)).collect())
    assert got == jaccard_brute(texts)


def test_jaccard_join_edges(spark):
    assert parity_join.jaccard_components(frame(spark, [])).collect() == []
    rows = parity_join.jaccard_components(frame(spark, ["same words in all of these"] * 4, [7, None, 7, 9])).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(7, 2, 7), (7, 2, 7), (9, 2, 7), (None, 2, None)], key=str)


def test_pigeonhole_bound():
    for low in range(2, 80):
        for high in range(low, low + 30):
            want = max(s - 2 * -(-3 * s // 7) for s in range(low, high + 1))
            assert parity_join.most_different(low, high) == want
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 40, 300):
        for _ in range(40):
            a = np.sort(rng.integers(0, 2**64, n, np.uint64))
            drop, add = rng.integers(0, n // 7 + 1), rng.integers(0, n // 7 + 1)
            b = np.sort(np.concatenate([a[drop:], rng.integers(0, 2**64, add, np.uint64)]))
            common = n - drop
            if len(b) and 4 * common >= 3 * (n + len(b) - common):
                none = np.empty(0, np.uint64)
                assert np.intersect1d(parity_join.chunk_places(a, 8, none), parity_join.chunk_places(b, 8, none)).size
                x, y = parity_join.parity_sketch(a), parity_join.parity_sketch(b)
                size = min(len(x), len(y))
                apart = int(np.bitwise_count(parity_join.folded(x, size) ^ parity_join.folded(y, size)).sum())
                assert apart <= n + len(b) - 2 * common <= parity_join.allowed(n + len(b))


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)] + [(2000, k) for k in range(2001, 2100)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    got = dict(components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


def test_word_hashes_tell_words():
    text = "aa b aa ab ba\tb\n\x0baa\xa0x é".encode()
    words = text.split()
    h = word_hashes(text).tolist()
    assert len(h) == len(words) and len(set(h)) == len(set(words))
    assert [h.index(x) for x in h] == [words.index(w) for w in words]
    assert word_hashes(b"").size == word_hashes(b"  \n").size == 0


def base_brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(8)} if len(grams) < 3000 else set(range(len(words)))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_quality_base_counts(spark):
    rep = prose(12)
    texts = HARD + [rep + " " + prose(30) + " " + rep, "a a a a a a a a a", "l\nl\n \n \nl ", "x # y\n" * 40, prose(25), "\n\n"]
    rows = quality_rules.judge(frame(spark, texts)).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows}
    assert got == {i: base_brute(t) for i, t in enumerate(texts)}
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality_rules.judge(frame(spark, [])).collect() == []


def test_quality_labels_agree(spark):
    d = "/root/testdata/sf0.01"
    out = quality_rules.op4_quality_rules(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("not base_failed")
    good = out.where("quality = 1").agg({"kept": "count"}).first()[0]
    assert out.where("quality = 1 and kept").count() > 0.98 * good
    assert out.where("quality = 0 and not kept").count() > 0.9 * out.where("quality = 0").count()


def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    k, truth = len(quality_rules.RULES), rng.random(4000) < 0.8
    votes = np.where(rng.random((4000, k)) < 0.85, np.where(truth, 1, 2)[:, None], np.where(truth, 2, 1)[:, None])
    votes[rng.random((4000, k)) < 0.2] = 0
    patterns, counts = np.unique((votes * 3 ** np.arange(k)).sum(1), return_counts=True)
    prior, p, post = quality_rules.fit(patterns.tolist(), counts.tolist())
    assert abs(prior - 0.8) < 0.03 and abs(p[:, 0, 1] / (p[:, 0, 1] + p[:, 0, 2]) - 0.85).max() < 0.04
    known = dict(zip(patterns.tolist(), post, strict=True))
    said = np.array([known[x] > 0.5 for x in (votes * 3 ** np.arange(k)).sum(1).tolist()])
    assert (said == truth).mean() > 0.97


def winnow_brute(text):
    if not text:
        return []
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if len(codes) < winnowing.K:
        return None
    h = winnowing.gram_hashes(codes).tolist()
    w, out = min(winnowing.WINDOW, len(h)), {}
    for a in range(len(h) - w + 1):
        low = min(h[a : a + w])
        out[max(a + j for j in range(w) if h[a + j] == low)] = low
    return sorted((p, x) for p, x in out.items())


def test_winnowing_selection_and_guarantee():
    for text in [t or "" for t in HARD] + ["aaaa" * 40, prose(9), prose(40), prose(300), "ab" * 300]:
        want = winnow_brute(text)
        h, p = winnowing.winnow(text)
        if want is not None:
            assert list(zip(p.tolist(), h.tolist(), strict=True)) == want
        else:
            assert len(h) == 1
    shared = prose(40)[: winnowing.WINDOW + winnowing.K - 1]
    for _ in range(30):
        a, b = winnowing.winnow(prose(20) + shared + prose(9)), winnowing.winnow(prose(3) + shared + prose(25))
        assert np.intersect1d(a[0], b[0]).size


@pytest.mark.parametrize("per_bucket", [4000, 3])
def test_winnowing_neighbours(spark, monkeypatch, per_bucket, tmp_path):
    monkeypatch.setattr(winnowing, "DOCS_PER_BUCKET", per_bucket)
    texts = HARD + [prose(n) for n in (1, 5, 30, 100, 101)] + ["twin text " * 20] * 2
    ids = [3 * k - 20 for k in range(len(texts))]
    frame(spark, texts, ids).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in winnowing.op5_winnowing(spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    for k, i in enumerate(ids):
        text, after = texts[k] or "", texts[(k + 1) % len(ids)] or ""
        changed = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        a, b, c = (set(winnowing.winnow(t)[0].tolist()) for t in (text, changed, after))
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert r.near_edited == pytest.approx(like(a, b)) and r.near_next == pytest.approx(like(a, c))
        assert r.fingerprint == winnowing.as_string(*winnowing.winnow(text))


def test_winnowing_edges(spark, tmp_path):
    frame(spark, ["only one document here, alone"], [4]).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    (row,) = winnowing.op5_winnowing(spark, str(tmp_path / "a")).collect()
    assert row.near_next == 1.0
    frame(spark, []).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert winnowing.op5_winnowing(spark, str(tmp_path / "b")).collect() == []
    frame(spark, ["second one", "first one", "null id"], [5, 5, None]).write.parquet(str(tmp_path / "c" / "documents.parquet"))
    assert sorted(str(r.doc_id) for r in winnowing.op5_winnowing(spark, str(tmp_path / "c")).collect()) == ["5", "5", "None"]


def test_hilbert_key_walks_the_grid():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = hilbert_pack.hilbert_key(grid, bits)
        walk = grid[np.argsort(key)]
        assert sorted(key.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


ODD = ["don't it's I'LL we'Ve", "ÉTÉ Straße œuvre ñÑ İstanbul ΣΑΣ", "a1b22 3.14 x_y -- ... ?!, <|endoftext|> <|STARTOFTEXT|>x", "é T̈ äb ́x", "\x1cfs\x85nel\xa0nbsp", "\x7f x\xady", "½ x² ª"]


def test_packing_is_exact(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = HARD + ODD + [prose(n) for n in (1, 50, 400, 3000)] + [prose(90)] * 40
    frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = hilbert_pack.op2_packing(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in texts]
    parts, sequences = {}, {}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        assert r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        parts.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(parts) == len(texts)
    for pieces, total in [(p, len(ids[i])) for i, p in parts.items()] + [(p, None) for p in sequences.values()]:
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == total if total else at <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_packing_edges(spark):
    assert hilbert_pack.pack(frame(spark, [])).collect() == []
    rows = hilbert_pack.pack(frame(spark, ["a b", "a b", None], [1, 1, None])).collect()
    assert sum(r.length for r in rows) == 3 + 3 + 1


PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>'
    '<nav><ul><li><a href="/a">Home</a></li><li><a href=/b>News</a></ul></nav><div class="ad">Buy this now.</div>'
    '<article><h1>The title &amp; more</h1><p><b>First   words of\n the text<br>go on.<p>Second &lt;b&gt; part &#233; with a <a href="/x">link</a>.</p>'
    '<div class="ad">Another advert here.</div><ul><li>An item of it<li>Another item of it</ul></article>'
    '<section id="comments"><div class="comment"><p>I liked this a lot.</p></div></section><footer>&copy; site. All rights.</footer></body></html>'
)


def test_extraction(spark):
    field = html_crf.trained_field()
    want = "The title & more\nFirst words of the text go on.\nSecond <b> part é with a link.\nAn item of it\nAnother item of it"
    assert field.extract(PAGE) == want
    for broken in (None, "", "<", "<p", "<p>", "</p></div>", "<!-- never closed <p>x", "<script>never closed", "&amp;", "<a href='x>y", "<" * 5000, "<p " + "a='" * 3000, "plain text only"):
        assert isinstance(field.extract(broken), str)
    rows = [(1, "u", PAGE, "c"), (1, "u", PAGE, "c"), (2, None, None, "c"), (None, "v", "", "c")]
    got = html_crf.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"), field).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got) == [("1", len(want)), ("1", len(want)), ("2", 0), ("None", 0)]
    assert html_crf.extract(spark.createDataFrame([], "page_id bigint, url string, html string"), field).collect() == []


def test_field_on_unseen_layouts():
    field = html_crf.trained_field()
    wrong = total = 0
    for rows, labels in html_crf.labelled_pages(200, seed=99):
        found = field.decode(rows)
        wrong += sum(a != b for a, b in zip(found, labels, strict=True))
        total += len(labels)
    assert wrong < 0.01 * total


def test_viterbi_is_the_best_sequence():
    rng = random.Random(4)
    names = [f"f{k}" for k in range(6)]
    field = html_crf.Field({f: (rng.uniform(-2, 2), rng.uniform(-2, 2)) for f in names}, [[rng.uniform(-2, 2) for _ in "ab"] for _ in "ab"], [0.3, -0.2])
    for _ in range(30):
        rows = [rng.sample(names, 3) for _ in range(rng.randint(1, 7))]

        def value(ys):
            v = field.start[ys[0]] + sum(field.moves[a][b] for a, b in zip(ys, ys[1:], strict=False))
            return v + sum(field.weights[f][y] for y, r in zip(ys, rows, strict=True) for f in r)

        every = [[(k >> i) & 1 for i in range(len(rows))] for k in range(1 << len(rows))]
        assert value(field.decode(rows)) == pytest.approx(max(map(value, every)))


def test_warc_round_trip(spark, tmp_path):
    big = "<html>" + prose(60) + "</html>"
    rows = [(5, "http://a/x y\r\n", big), (3, None, big), (9, "http://b/é", big), (1, "u", None), (2, "u", ""), (4, "u", "short"), (6, "u", "short"), (None, "u", big), (7, "u", "é" * 50), (8, "u", "é" * 50)]
    rows += [(100 + k, f"http://h/{k}", "<p>" + prose(40)) for k in range(60)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, digest string")
    folder = "file://" + str(tmp_path / "warc")
    names = warc_dict.write_archives(pages, folder).collect()
    assert names and all(n.bytes > 0 for n in names)
    assert warc_dict.read_archives(spark, folder).count() == len(rows)
    got = {r.page_id: r for r in warc_dict.read_archives(spark, folder).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        raw = (html or "").encode()
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        first = min(j for j, _, h in rows if h == html and j is not None)
        again = len(raw) >= 100 and i != first
        assert (r.record_type, r.refers_to) == (("revisit", first) if again else ("response", None))
        assert r.payload == (None if again else raw)


def test_warc_file_layout():
    records = [warc_dict.record(k, "http://x/", (f"<p>{k} " + prose(50)).encode(), "0" * 64, None) for k in range(200)]
    data = warc_dict.archive(records)
    size = int.from_bytes(data[4:8], "little")
    assert data[:4] == b"\x5d\x2a\x4d\x18" and size > 1000
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    at, seen = 8 + size, []
    while at < len(data):  # each record is a frame that stands alone
        one = unpack.decompressobj()
        seen.append(one.decompress(data[at:]))
        at = len(data) - len(one.unused_data)
    assert seen == records
    assert len(data) - size < 0.8 * sum(len(zstandard.compress(r, 3)) for r in records)
    assert [b for _, b in warc_dict.read_archive(warc_dict.archive(records[:3]))] == [r.split(b"\r\n\r\n", 1)[1][:-4] for r in records[:3]]
    assert list(warc_dict.read_archive(b"")) == [] and io.BytesIO(data).read(4)


def test_warc_empty(spark, tmp_path):
    spark.createDataFrame([], "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert warc_dict.op7_warc(spark, str(tmp_path)).collect() == []


def test_toxicity_held_out(spark):
    rows = pu_toxicity.op8_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    hit = sum(r.toxic and r.predicted for r in rows)
    assert hit > 0.85 * sum(r.toxic for r in rows)
    assert hit > 0.85 * sum(r.predicted for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)


def test_toxicity_edges(spark, tmp_path):
    texts = HARD + ["you vile thing " + prose(10) for _ in range(30)] + [prose(12) for _ in range(60)]
    frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, int("vile" in (t or ""))) for i, t in enumerate(texts)] + [(None, 1, 1), (5, None, None), (9999, 0, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = pu_toxicity.op8_toxicity(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) and all(r.predicted == int("vile" in (texts[r.doc_id] or "")) for r in rows)
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.mode("overwrite").parquet(str(tmp_path / "labels.parquet"))
    assert not any(r.predicted for r in pu_toxicity.op8_toxicity(spark, str(tmp_path)).collect())
    frame(spark, []).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert pu_toxicity.op8_toxicity(spark, str(tmp_path)).collect() == []
