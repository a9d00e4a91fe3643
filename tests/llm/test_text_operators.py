"""Secrets, line dedup, Jaccard join, fingerprints, segmentations, packing: against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticeworks.llm import jaccard, lines, packing, pieces, secrets, syncmers
from noticeworks.llm.components import components
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def spans_of(text):
    found = []
    patterns = [
        ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
        ("access", r"AKIA[A-Z0-9]+", 0, 16),
        ("hex", r"[0-9a-f]+", 0, 32),
    ]
    for rank, (kind, p, g, n) in enumerate(patterns):
        found += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(p, text or "") if len(m[g]) >= n]
    return [x[2] for x in sorted(found)]


def test_base_secrets(spark, corpus, clashing, nothing):
    tricky = ["é漢" + "password: token: abcdefghij", "Token=\"a1b2c3d4-._=\" tail", "f" * 31, "0" * 32 + "g", "AKIAAKIA" + "Z" * 8, "AKIA" + "a", "secret = 'x' SECRET='longenough1'", "api_key:apikey=12345678", "x" * 100_000, "passwd=" * 400]
    more = spark.createDataFrame([(1000 + i, t, "en", f"o{i}", 1) for i, t in enumerate(tricky)], corpus.schema)
    rows = secrets.find_secrets(clashing.select(corpus.columns).union(more)).select("doc_id", "_key", secrets.shown(F.filter("spans", lambda s: s["rank"] < 3)).alias("s")).collect()
    keyed = defaultdict(set)
    for r in corpus.union(more).collect():
        keyed[r.doc_id].add(",".join(spans_of(r.text)))
    assert len(rows) == corpus.count() + len(tricky) and all(r.s in keyed[r.doc_id] for r in rows)
    assert secrets.find_secrets(nothing).count() == 0
    assert secrets.redact_secrets(clashing).columns == clashing.columns and secrets.redact_secrets(clashing).where("text LIKE '%abcdefgh1%'").count() == 0


def test_ownership_separates_copies_from_live_ones(spark):
    copied, live = "EXAMPLEkey0123456789abcdXY", "Zq8pLm2Vx9Rt4Ks7Wd1Nb6Hy"
    rows = [(i, f"see {copied} here", "en", f"s{i}", 1) for i in range(9)] + [(50, f"see {copied} and {live}", "en", "s1", 1), (51, f"{live}", "en", "s1", 1), (52, "aaaaaaaaaaaaaaaaaaaaaaaaaa 11111111111111111111111", "en", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.s for r in secrets.find_secrets(df).select("doc_id", secrets.shown(F.filter("spans", lambda x: x["rank"] < 4)).alias("s")).collect()}
    assert got[50] == f"other:{9 + len(copied)}:{9 + len(copied) + len(live)}" and got[51] == "other:0:24" and got[0] == got[52] == ""
    red = {r.doc_id: r for r in secrets.redact_secrets(df.union(spark.createDataFrame([(60, "é password=abcdefgh1 x", "en", "s", 1), (61, None, "en", "s", None)], df.schema))).collect()}
    assert red[51].text == "[other:live]" and red[60].text == "é [assign:live] x" and red[60].n_chars == 17 and red[0].text == rows[0][1] and red[61].text is None


def test_owners_decide_which_spans_are_added(spark):
    """A secret of one owner gets a live span; one of many owners or many texts none. Copies of a
    text count once."""
    rows = [(i, f"text {i} token=SHAREDexample1", "en", f"s{i}", 1) for i in range(3)] + [(10 + i, "password: mine12345 é", "en", "s1", 1) for i in range(9)]
    rows += [(20 + i, f"copy {i} secret=spread98765", "en", "s2", 1) for i in range(5)] + [(30, "token=abcd1234efgh and bare Zq8pLm2Vx9Rt4Ks7Wd1Nb6Hy", "en", "s9", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.s, r.spans) for r in secrets.find_secrets(df).select("doc_id", secrets.shown(F.col("spans")).alias("s"), "spans").collect()}
    assert got[0][0] == "assign:7:27" and [(s.owners, s.live) for s in got[0][1]] == [(3, False)]
    assert all(got[10 + i][0] == "assign:0:19,live:10:19" and got[10 + i][1][0].repositories == 1 for i in range(9))
    assert got[20][0] == "assign:7:25" and (got[20][1][0].repositories, got[20][1][0].owners) == (5, 1)
    assert got[30][0] == "assign:0:18,live:6:18,other:28:52"
    by_column = secrets.find_secrets(df, repository="source", owner="lang").where("doc_id = 0").first()
    assert (by_column.spans[0].repositories, by_column.spans[0].owners) == (3, 1)


def test_a_text_full_of_secrets(spark):
    text = " ".join(["AKIA" + "B" * 16, "token=abcdefgh12345678901234567890", "x" * 19 + "1/" + "f" * 32, "0" * 32 + "Zz" * 12] * 2000)
    row = secrets.find_secrets(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")).first()
    base = [s for s in row.spans if s.rank < 3]
    assert len(base) == len(spans_of(text))
    assert not any(s.rank == 3 and b.start < s.end and s.start < b.end for s in row.spans[:400] for b in base[:400])


def deleted_lines(rows, least):
    """Lines in some run of so many words whose equal came earlier, by comparing every start with every earlier one."""
    flat = []
    for d, (key, text) in enumerate(sorted(rows, key=lambda r: r[0])):
        flat += [(d, i, x, len(WORD.findall(x))) for i, x in enumerate((text or "").split("\n")) if WORD.search(x)]
    gone = defaultdict(set)
    for b in range(len(flat)):
        for a in range(b):
            k = 0
            while b + k < len(flat) and flat[a + k][0] == flat[a][0] and flat[b + k][0] == flat[b][0] and flat[a + k][2] == flat[b + k][2]:
                k += 1
            if sum(x[3] for x in flat[b : b + k]) >= least:
                gone[flat[b][0]].update(range(flat[b][1], flat[b + k - 1][1] + 1))
    return [gone[d] for d in range(len(rows))]


def test_line_runs(spark, nothing):
    p, q = "\n".join(prose(1, 72).split("\n")), prose(2, 60)
    texts = [p, "x y\n" + p + "\nz", q.replace("\n", "\n\n"), q, "\n".join(p.split("\n")[1:5]), p.split("\n")[0] + "\n" + "\n".join(p.split("\n")[2:]), "same line of five\n" * 30, None, "", "w " * 60 + "\n" + "w " * 60, "one\n" * 49, "one\n" * 60, q + "\n" + p, "\n\n"]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in lines.dedup_lines(df, 50).collect()}
    for i, gone in enumerate(deleted_lines(list(enumerate(texts)), 50)):
        want = texts[i] if not gone else "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in gone)
        assert got[i].text == want, i
    assert lines.dedup_lines(nothing).count() == 0


def test_line_dedup_of_the_corpus(corpus, clashing):
    done = lines.dedup_lines(clashing)
    assert done.columns == clashing.columns and done.count() == corpus.count()
    rows = {(r.doc_id, r.text) for r in corpus.collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5(f"{'' if r[0] is None else r[0]}|{chr(0) if r[1] is None else r[1]}".encode()).hexdigest()))
    gone = deleted_lines([(i, t) for i, (_, t) in enumerate(order)], 50)
    want = {(d, t if not g else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in g)) for (d, t), g in zip(order, gone, strict=True)}
    assert {(r.doc_id, r.text) for r in done.collect()} == want


def shingles(text, k):
    w = (text or "").encode().translate(jaccard._LOWER).split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(rows, rule):
    sets = [shingles(t, rule.words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and rule.den * common >= rule.num * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in groups.items()}
    return Counter((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows)))


def edited(seed, n, edits):
    """A text and copies with more and more words changed, so that likeness crosses the threshold."""
    words = prose(seed, n).split()
    out = []
    for e in range(edits):
        copy = list(words)
        for k in range(e):
            copy[(k * 37 + seed) % n] = f"new{seed}x{e}y{k}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("rule", [jaccard.Threshold(3, 90, 100), jaccard.Threshold(5, 80, 100, group=4), jaccard.Threshold(1, 50, 100)])
def test_components_are_exact(spark, corpus, rule):
    texts = [t for s in range(4) for t in edited(s, 60 + 90 * s, 9)] + [" ".join(prose(7, 300).split()[i : i + 200]) for i in range(0, 60, 4)] + ["a b c d", "a b c d e", "A B C D", "b c", "b c"]
    rows = [(i * 5 % 97, t) for i, t in enumerate(texts)] + [(r.doc_id, r.text) for r in corpus.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("mine"))
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_components(df, rule).collect())
    assert got == brute_components(rows, rule)


def test_opened_pairs_are_bounded_by_what_one_cluster_has_alone(spark):
    rule = jaccard.Threshold(1, 90, 100)
    common = list(range(1000, 1013))
    # 100 tokens each: 95 in common are needed, so up to 5 of a set's tokens may be its cluster's alone
    alone = {"w": 0, "x": 2, "y": 5, "z": 6}
    rows = [(s, 100, [10 * i + j for j in range(k)] + common[k:], i, 7, i) for i, (s, k) in enumerate(alone.items())]
    sets = spark.createDataFrame(rows, "sid string, n long, prefix array<bigint>, cluster long, group long, member int")
    assert {tuple(r) for r in jaccard.group_pairs(sets, rule).collect()} == {("w", "x"), ("w", "y"), ("x", "y")}


def test_one_of_each_group_stays(corpus, nothing):
    kept = jaccard.keep_one(corpus)
    assert kept.columns == corpus.columns and jaccard.keep_one(nothing).count() == 0
    found = jaccard.similar_components(corpus).where("n_shingles > 0").collect()
    stay = {(r.doc_id, r.text) for r in kept.collect()}
    assert {r.component_id for r in found} == {d for d, t in stay if (t or "").split()}


def test_bitmaps_bound_what_is_common():
    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (40, 41), (500, 700), (64, 1)):
        pool = rng.integers(0, 2**63, 900).astype(np.uint64) * np.uint64(2)
        a, b = np.unique(rng.choice(pool, n)), np.unique(rng.choice(pool, m))
        assert jaccard.most_common(jaccard.bitmap(a), len(a), jaccard.bitmap(b), len(b)) >= len(np.intersect1d(a, b))
        assert jaccard.most_common(jaccard.bitmap(a), len(a), jaccard.bitmap(a), len(a)) == len(a)


def test_components_of_chains(spark):
    links = [(f"{i:03}", f"{i + 1:03}") for i in range(0, 90) if i % 30 != 29] + [("200", "200"), ("x", "y"), ("y", "z"), ("z", "x")]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {f"{i:03}": f"{i // 30 * 30:03}" for i in range(90)} | {"x": "x", "y": "x", "z": "x"}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_syncmers_are_closed_and_free_of_context():
    text = prose(5, 300)
    at, hashes = syncmers.anchors(text)
    assert (at == sorted(at)).all()
    where = dict(zip(hashes.tolist(), at.tolist(), strict=True))
    cut_at, cut = syncmers.anchors("zzz" + text[100:900] + "yyyy")
    inside = [(h, p) for h, p in zip(cut.tolist(), cut_at.tolist(), strict=True) if 3 <= p <= 803 - 24]
    assert len(inside) > 50 and all(where[h] == p - 3 + 100 for h, p in inside)
    assert {p for p in at if 100 <= p <= 900 - 24} == {p - 3 + 100 for _, p in inside}
    assert 0.08 < len(at) / len(text) < 0.16
    assert len(syncmers.anchors("")[0]) == 0 and len(syncmers.anchors("short")[0]) > 1


def chained(a, b, size=128):
    """Likeness by comparing every anchor with every other: the longest common subsequence."""
    a, b = a.tolist(), b.tolist()
    union = sorted({*a, *b})[:size]
    if not union:
        return 1.0
    row = [0] * (len(b) + 1)
    for x in a:
        before = list(row)
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y and x in union else max(row[j], before[j + 1])
    return row[-1] / len(union)


@pytest.mark.parametrize(("s", "k"), [(8, 24), (5, 11), (3, 17), (1, 2), (4, 4)])
def test_any_s_and_k(s, k):
    """Against every k-mer's s-mers: the k-mers chosen by one hash of s-mers are closed syncmers."""
    text = prose(3, 120)
    options = syncmers.Syncmers(s=s, k=k, short=0)
    at, hashes = syncmers.anchors(text, options)
    assert len(at) and all(h == g for p, h in zip(at, hashes, strict=True) for q, g in zip(at, hashes, strict=True) if text[p : p + k] == text[q : q + k])
    assert len({(int(h), text[p : p + k]) for p, h in zip(at, hashes, strict=True)}) == len(set(hashes.tolist()))
    single, points = None, np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    single = (points + np.uint64(1)) * syncmers._MIX[0]
    h = syncmers._mixed(syncmers._joined(single, 1, s, single, 13)[0])
    assert len(h) == len(text) - s + 1
    want = [i for i in range(len(text) - k + 1) if min(h[i : i + k - s + 1]) in (h[i], h[i + k - s])]
    assert at.tolist() == want


def test_a_hot_doc_id_and_null_ones_are_dealt_out(spark):
    """Rows of one doc_id, and of none, go to many ranges and still follow each other."""
    rows = [(5 if i % 3 else None if i % 2 else i, prose(i, 30)) for i in range(240)] + [(2**60 + i, f"text {i}") for i in range(3)]
    key = lambda r: hashlib.md5(f"{'' if r[0] is None else r[0]}|{r[1]}".encode()).hexdigest()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, key(r)), reverse=True)
    want = Counter((d, hashlib.sha256((t[: len(t) - len(t) // 2] + order[(i + 1) % len(order)][1][: len(t) // 2]).encode()).hexdigest()) for i, (d, t) in enumerate(order))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter((r.doc_id, r.edited_sha256) for r in syncmers.compare_with_edits(df).collect()) == want
    dealt, _ = syncmers._in_order(df)
    assert dealt.where("doc_id = 5").select("_bucket").distinct().count() >= 4 and dealt.where("doc_id IS NULL").select("_bucket").distinct().count() >= 2


def test_short_texts_keep_what_an_edit_left_alone():
    for n in (10, 20, 40, 100, 180):
        text = prose(8, 60)[:n]
        near = syncmers.likeness(syncmers.sketch(text), syncmers.sketch(text[: n - n // 4] + "z" * (n // 4)), 128)
        assert 0.2 < near < 1.0, n


def test_edits_follow_the_next_document(spark, corpus, clashing, nothing):
    rows = [(r.doc_id, r.text or "", hashlib.md5(f"{'' if r.doc_id is None else r.doc_id}|{r.text or ''}".encode()).hexdigest()) for r in corpus.collect()]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]), reverse=True)
    want = Counter()
    for i, (d, t, _) in enumerate(order):
        n, nxt = len(t), order[(i + 1) % len(order)][1]
        e = t[: n - n // 2] + nxt[: n // 2]
        a, b, c = (syncmers.sketch(x) for x in (t, e, nxt))
        want[d, n, hashlib.sha256(e.encode()).hexdigest(), a.astype(">u4").tobytes().hex(), b.astype(">u4").tobytes().hex(), chained(a, b), chained(a, c)] += 1
    got = syncmers.compare_with_edits(clashing).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in got) == want
    assert syncmers.compare_with_edits(nothing).count() == 0
    lone = syncmers.compare_with_edits(spark.createDataFrame([(1, "abc" * 40)], "doc_id long, text string")).first()
    assert lone.near_next == 1.0
    marked = syncmers.with_fingerprints(corpus.select("doc_id", "text")).collect()
    assert all([a.position for a in r.anchors] == syncmers.anchors(r.text or "")[0].tolist() for r in marked)


def all_paths(text, v):
    normal = {v.pieces[i]: i for i in range(v.bytes_from + 256, len(v.pieces))}
    if not text:
        return [()]
    found = []
    for n in range(1, len(text) + 1):
        if text[:n] in normal:
            found += [(normal[text[:n]], *rest) for rest in all_paths(text[n:], v)]
    return found


def test_gumbel_top_k_is_sampling_without_replacement():
    v = pieces.vocabulary(pieces.default_model(), 0.2, 10.0)
    paths = all_paths("▁ab▁on", v)
    weights = np.array([np.prod([(i - v.bytes_from - 256 + 1 + 10.0) ** -0.2 for i in p]) for p in paths])
    weights /= weights.sum()
    n = 8000
    got = pieces.sample_block(["ab on"] * n, list(range(n)), v, pieces.Sampling(samples=3, power=0.2))
    first, pairs = Counter(), Counter()
    for rows in got:
        keys = [tuple(map(int, r[0])) for r in rows]
        assert len(set(keys)) == 3 and [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True) and all(r[3] <= 0 for r in rows)
        first[keys[0]] += 1
        pairs[keys[0], keys[1]] += 1
        assert abs(rows[0][1] - np.log(weights[paths.index(keys[0])])) < 1e-9
    order = np.argsort(-weights)
    for i in order:
        assert abs(first[paths[i]] / n - weights[i]) < 4 * np.sqrt(weights[i] / n) + 1e-3
    i, j = order[:2]
    want = weights[i] * weights[j] / (1 - weights[i])
    assert abs(pairs[paths[i], paths[j]] / n - want) < 4 * np.sqrt(want / n) + 1e-3
    few = pieces.sample_block(["ab on"], [1], v, pieces.Sampling(samples=100, power=0.2))[0]
    assert {tuple(map(int, r[0])) for r in few} == set(paths) and all(r[3] == 0 for r in few)


def test_samples_decode_to_the_text(spark, corpus, clashing, nothing):
    more = spark.createDataFrame([(900, "  two  spaces\n\n\ttab é漢😀 \x00 end "), (901, "a" * 300), (902, " ")], "doc_id long, text string")
    docs = clashing.select("doc_id", "text").union(more)
    path = pieces.default_model()
    back = pieces.decode_samples(pieces.encode_samples(docs, path), path).collect()
    texts = defaultdict(set)
    for r in docs.collect():
        texts[r.doc_id].add(r.text)
    assert all(r.text in texts[r.doc_id] for r in back)
    count = Counter(r.doc_id for r in back)
    assert count[900] == 2 and count[901] == 2
    assert pieces.encode_samples(nothing, path).count() == 0
    again = pieces.encode_samples(docs.orderBy(F.rand(1)).repartition(3), path)
    assert Counter((r.doc_id, r["sample"], tuple(r.ids)) for r in again.collect()) == Counter((r.doc_id, r["sample"], tuple(r.ids)) for r in pieces.encode_samples(docs, path).collect())


def test_word_ids_are_the_tokenizers(corpus):
    path = packing.default_tokenizer()
    t = packing._tokenizer(path)
    texts = [r.text or "" for r in corpus.collect()] + ["İSS ß Σας's we'll 12½² <|endoftext|>x", "a\x1cb\x85c　d é", "\x00", "漢字ＡÅ"]
    for text, ids in zip(texts, packing.WordIds(path).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_encode_whole_texts():
    """Every JSON tokenizer at hand: the ids of texts are its own, by words or not."""
    from pathlib import Path

    path = packing.default_tokenizer()
    assert packing.by_words(path)
    texts = ["Two words,  three's 12 <|endoftext|>x", "é漢 \n\n x", "", "A a"]
    for other in sorted(Path(path).parent.glob("*.json")):
        try:
            t = packing._tokenizer(str(other))
        except Exception:  # not a tokenizer's file
            continue
        for text, ids in zip(texts, packing.WordIds(str(other)).encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, (other.name, text)


def check_packing(pieces_of, rows, capacity):
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(filled)


def test_packing(spark, corpus, clashing, nothing):
    path = packing.default_tokenizer()
    rows = packing.pack_documents(clashing, path, 512).collect()
    t = packing._tokenizer(path)
    want = Counter()
    for r in corpus.collect():
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 1]
        for n, s in enumerate(range(0, len(ids), 512)):
            part = ids[s : s + 512]
            want[r.doc_id, n, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    used = check_packing(want, rows, 512)
    assert used == packing.sequences_of(packing.plan_fillings(Counter(r.length for r in rows), 512)) >= packing.lower_bound(Counter(r.length for r in rows), 512)
    assert packing.pack_documents(nothing, path).count() == 0


@pytest.mark.parametrize("sizes", [{1: 5000}, {4096: 3, 1: 1}, {2049: 10, 2047: 10, 1000: 4}, {1366: 9, 1365: 9}, {7: 100_000, 4090: 10}, {}])
def test_plans_use_up_all_and_fill(sizes):
    plan = packing.plan_fillings(dict(sizes))
    used = Counter()
    for filling, times in plan:
        assert sum(filling) <= 4096
        for size in filling:
            used[size] += times
    assert used == sizes
    bins = sum(times for _, times in plan)
    assert bins <= -(-sum(k * n for k, n in sizes.items()) // 4096) + (5 if 1366 in sizes else 1)


def fewest(items, capacity):
    """The least number of sequences, by trying every place of every item."""
    best = len(items)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= items[i]}.values():
            go(i + 1, rooms[:j] + [rooms[j] - items[i]] + rooms[j + 1 :])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best


def decreasing(items, capacity):
    rooms = []
    for x in items:
        fits = [r for r in rooms if r >= x]
        rooms.append((min(fits) if fits else capacity) - x)
        if fits:
            rooms.remove(min(fits))
    return len(rooms)


def test_plans_are_the_least_possible():
    assert packing.sequences_of(packing.plan_fillings(dict.fromkeys((1226, 1539, 992, 926, 2113, 1606, 1502, 1548), 1))) == 3
    rng, fewer = np.random.default_rng(11), 0
    for _ in range(600):
        capacity = int(rng.choice([20, 50, 100, 4096]))
        items = sorted(rng.integers(1, 1 + int(capacity * rng.choice([0.5, 0.7, 1.0])), rng.integers(1, 11)).tolist(), reverse=True)
        counts = Counter(items)
        plan = packing.plan_fillings(counts, capacity, None)
        assert sum((Counter({x: n * filling.count(x) for x in set(filling)}) for filling, n in plan), Counter()) == counts
        assert packing.lower_bound(counts, capacity) <= packing.sequences_of(plan) == fewest(items, capacity), (items, capacity)
        assert packing.sequences_of(packing.best_fit_decreasing(counts, capacity)) == decreasing(items, capacity)
        fewer += packing.sequences_of(plan) < decreasing(items, capacity)
    assert fewer


def test_plans_are_never_worse_than_best_fit_decreasing():
    rng = np.random.default_rng(12)
    for n, top in ((40, 2500), (300, 2500), (300, 4097), (200, 1400)):
        items = sorted(rng.integers(200, top, n).tolist(), reverse=True)
        assert packing.sequences_of(packing.plan_fillings(Counter(items), steps=500)) <= decreasing(items, 4096)


def test_bin_completion_beats_first_fit():
    """6 + 4 fills what 6 + 3 doesn't; a greedy choice of 5 would leave waste."""
    left = {3: 1, 4: 1, 5: 1, 7: 1}
    assert sum(packing.complete_bin(sorted(left), left, 11)) == 11
    assert packing.complete_bin([3], {3: 1}, 2) == []
