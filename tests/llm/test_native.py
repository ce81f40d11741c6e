"""The operators made of DataFrame functions, on small hard cases."""

import hashlib
import math
import re

from pyspark.sql import functions as F

from timeline_engine.llm import line_dedup, mixing, url_filter

DOCS = "doc_id bigint, text string, source string, word string, pos int, hash bigint"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "w", 7, 9) for i, t, s in rows], DOCS)


def dedup_brute(rows):
    first = {}
    key = lambda line: re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                first.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and i != min(first[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def dedup(df):
    out = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df))
    got = out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)).collect()
    return sorted(tuple(r) for r in got)


def test_line_dedup_cases(spark):
    shared = "a shared line of text"
    rows = [
        (5, f"{shared}\nown five\n{shared}"),
        (3, f"  {shared.upper()}\t\nown three\n\n"),
        (9, shared),
        (1, None),
        (2, ""),
        (4, "short\nshort"),
        (6, "short\nÉtoile filante\nétoile filante"),
        (7, "Étoile filante\r"),
        (8, "\n".join(f"line number {k % 90} of it" for k in range(300))),
        (10, "\n".join(f"line number {k} of it" for k in range(200, 60, -1))),
        (11, "x" * 200_000 + "\n" + shared),
    ]
    assert dedup(docs(spark, [(i, t, "s") for i, t in rows])) == dedup_brute(rows)


def test_line_dedup_salts_a_frequent_line(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_LEAST", 50)
    rows = [(i, f"a line that everyone has\nline {i} alone here\n" + "a line that everyone has") for i in range(300)]
    assert dedup(docs(spark, [(i, t, "s") for i, t in rows])) == dedup_brute(rows)


def test_line_dedup_repeated_rows_and_null_id(spark):
    rows = [(1, "one common long line\nrest"), (1, "one common long line\nrest"), (None, "one common long line"), (2, "one common long line")]
    got = dedup_rows = line_dedup.apply_bitmaps(docs(spark, [(i, t, "s") for i, t in rows]), line_dedup.keep_bitmaps(docs(spark, [(i, t, "s") for i, t in rows])))
    kept = {(r.doc_id, r.kept) for r in dedup_rows.collect()}
    assert got.count() == 4
    assert kept == {(None, "one common long line"), (1, "rest"), (2, "")}


def test_line_dedup_empty_table(spark):
    assert dedup(docs(spark, [])) == []


def waterfill(sizes, weights, most=3):
    target = [0.0] * len(sizes)
    total, open_ = float(sum(sizes)), set(range(len(sizes)))
    while True:
        level = (total - sum(target[i] for i in range(len(sizes)) if i not in open_)) / (sum(weights[i] for i in open_) or 1)
        over = [i for i in open_ if level * weights[i] > most * sizes[i]]
        for i in open_:
            target[i] = level * weights[i]
        if not over:
            return target
        for i in over:
            target[i] = float(most * sizes[i])
            open_.discard(i)


def test_mixing_targets_epochs_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MANY_ROWS", 16)
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), None if i % 11 == 0 else "abcdz"[min(i % 9, 4)]) for i in range(400)]
    rows += [(1000, None, "empty"), (1001, "", "empty"), (1002, " \t", "b"), (400, "one two", None)]
    df = docs(spark, rows)
    out = mixing.mix(df).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, mixing.mix(df.repartition(7)).collect()))
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.source, []).append(r)
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None]
    sizes = [sum(r["size"] for r in by[s]) for s in names]
    for name, target in zip(names, waterfill(sizes, [k % 3 + 1 for k in range(len(names))]), strict=True):
        rs = by[name]
        assert all(abs(r.target - target) < 1e-6 for r in rs)
        assert abs(sum(r.taken for r in rs) - target) <= 2
        epochs = {r.copies for r in rs}
        assert max(epochs) - min(epochs) <= 1 and max(epochs) <= 3


def mix_brute(rows, seed="mix"):
    """Words taken by source, document by document in the order of keys."""
    text = lambda t: t or ""

    def key(i, t):
        u = (int(hashlib.md5(f"{seed}{'null' if i is None else i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        share = 5.0 * sum(c in "#*$%&|<>!" for c in text(t)) / max(len(text(t)), 1)
        return -math.log(u) / (0.1 if t is None else max(0.1, 1.0 - share))

    names = sorted({s for _, _, s in rows if s is not None}, key=lambda s: s.encode()) + [None] * any(s is None for _, _, s in rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", text(t)))
    total = [sum(size(t) for _, t, s in rows if s == name) for name in names]
    taken = {}
    for name, whole, target in zip(names, total, waterfill(total, [k % 3 + 1 for k in range(len(names))]), strict=True):
        epochs = int(target // whole) if whole else 0
        rest, upto, over = target - epochs * whole, 0, []
        taken[name] = epochs * whole
        spent = 0
        mine = sorted((key(i, t), i is not None, i or 0, size(t)) for i, t, s in rows if s == name)
        for *_, n in mine:
            upto += n
            if rest > 0 and upto <= rest:
                spent = upto
            else:
                over.append(n)
        fit = min(over, key=lambda n: abs(rest - spent - n), default=0)
        taken[name] += spent + (fit if abs(rest - spent - fit) < rest - spent else 0)
    return taken


def mix_taken(df):
    out = {}
    for r in mixing.mix(df).collect():
        out[r.source] = out.get(r.source, 0) + r.taken
    return out


def test_mixing_rows_that_share_an_id(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MANY_ROWS", 16)
    rows = [(None, "w " * (1 + i % 5), "a") for i in range(150)] + [(7, "w " * 3, "b") for i in range(150)] + [(i, "w # " * (i % 9), "c") for i in range(200)]
    assert mix_taken(docs(spark, rows)) == mix_brute(rows)


def test_mixing_ranges_follow_the_rows(spark):
    equal = [(None, "same text", "a")] * 1000
    marked = [(i, "<#> <#>", "b") for i in range(1000)]
    df = docs(spark, equal + marked).select("doc_id", F.lit(1).alias("size"), F.xxhash64("text").alias("text_hash"), "source")
    weight = F.when(F.col("source") == "a", 1.0).otherwise(0.1)
    named = df.withColumns({"src_no": F.ascii("source"), "key": -F.ln(mixing.uniform(F.col("doc_id"), "mix")) / weight, "row": F.monotonically_increasing_id()})
    per = [r["count"] for r in mixing.ranges(named, 20).groupBy("part").count().collect()]
    assert sum(per) == 2000 and len(per) >= 18 and max(per) <= 250


def test_mixing_prefers_quality(spark):
    rows = [(i, ("clean words here " * 5) if i % 2 else ("#$% *&| <>% " * 5), "b") for i in range(400)] + [(1000 + i, "w " * 15, "a") for i in range(1200)]
    out = mixing.mix(docs(spark, rows)).where("source = 'b'").collect()
    top = max(r.copies for r in out)
    more = [r.doc_id % 2 for r in out if r.copies == top]
    assert len(more) < len(out) and sum(more) / len(more) > 0.6


def test_mixing_empty_table(spark):
    assert mixing.mix(docs(spark, [])).collect() == []


def url_brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(h + "/" + p), h + "/" + p, v) for v, h, p in rules if ("." + host).endswith("." + h) and path.startswith("/" + p)]
    best = max(fit, default=(0, None, default))
    return host, path, best[1], best[2]


def test_url_filter(spark):
    urls = [
        None, "", "no scheme", "http://", "https://WWW.Example.COM/en/7", "http://example.com/en/70.html?x=://y", "http://a.b.example.net/de/8#z",
        "http://example.net/de/9", "http://example.net", "http://example.net?de/8", "http://net/de/", "http://xnet/de/", "http://org/es/1", "http://a.org:80/es/1",
        "http://com/EN/1", "http://com/en", "http://.com/en/", "http://com./en/", "http://a..com/en/x", "ftp://x.com/en//", "http://example.com/en/7" + "y" * 50_000,
    ]
    rows = [(k, u, "old", "old") for k, u in enumerate(urls + urls)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, verdict string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.rules_table(spark)).collect()}
    assert got == {(k, *url_brute(u, url_filter.RULES)) for k, u, _, _ in rows}
    assert url_filter.judge(pages.limit(0), url_filter.rules_table(spark)).collect() == []


def test_url_filter_larger_lists_and_conflicts(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 0)
    rules = [("allow", f"h{k}.org", "p" * (k % 5)) for k in range(50)] + [("block", "h3.org", "ppp"), ("block", "org", "")]
    pages = spark.createDataFrame([(k, f"http://www.h{k % 60}.org/{'p' * (k % 7)}q") for k in range(200)], "page_id bigint, url string")
    got = {(r.page_id, r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.rules_table(spark, rules)).collect()}
    want = {(r.page_id, *url_brute(r.url, [x for x in rules if x != ("allow", "h3.org", "ppp")])[2:]) for r in pages.collect()}
    assert got == want
