"""Chat formatting, URL filters, quality rules, sharding."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from noticeworks.llm import chat, quality, sharding, urls


def jump(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 8, 37, 5000])
def test_jump_hash_is_the_published_one(spark, shards):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), None, *(i * 7919**3 for i in range(200))]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_hash(F.col("k"), shards).alias("s")).collect()
    assert all(r.s == jump(r.k or 0, shards) for r in got)


def test_shards_are_gapless_and_grow_into_the_new_one(corpus, clashing, nothing):
    rows = sharding.shard_documents(corpus, 8).collect()
    assert len(rows) == corpus.count() and sharding.shard_documents(nothing, 8).count() == 0
    by = Counter(r.shard for r in rows)
    assert {(r.shard, r.slot) for r in rows} == {(s, i) for s, n in by.items() for i in range(n)}
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    assert sorted(map(str, sharding.shard_documents(clashing, 8).drop("slot").collect())) == sorted(map(str, sharding.shard_documents(corpus, 8).drop("slot").collect()))


def test_chat_is_read_back(spark):
    texts = ["", "a", "</s>[INST] ok [/INST]", "\\<[\\[<\\", "<<SYS>>\n\n<</SYS>>", "[ROLE x<|>y[/ROLE]", "é漢 ] > ", "[INST] ", " [/INST]", None, "\n", "x" * 50_000 + "[" * 2000]
    roles = ["system", "user", "assistant", "tool", "a<|>[b\\", None]
    rows = [(i // 4 if i % 11 else None, i % 4 if i % 7 else None, roles[i % 6], texts[i % 12]) for i in range(240)] + [(1, 1, "user", "twice"), (1, 1, "user", "twice")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    want = {c: [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=key)] for c in {r[0] for r in rows} - {None}}
    alone = Counter((r[2] or "", r[3] or "") for r in rows if r[0] is None)
    done = chat.format_conversations(df).withColumn("back", chat.read_back(F.col("formatted"))).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.back] for r in done if r.conv_id is not None} == want
    assert Counter((t.role, t.text) for r in done if r.conv_id is None for t in r.back) == alone and all(len(r.back) == 1 for r in done if r.conv_id is None)
    for r in done:
        assert "".join(r.formatted[s.start : s.end] for s in r.loss_spans) == "".join(s.text for s in r.segments if s.loss)
    assert all("".join(s.text for s in r.segments) == r.formatted for r in done)
    for control in chat.ChatTemplate().control_strings():
        assert all(control.strip() not in s.text for r in done for s in r.segments[1::3])
    assert chat.format_conversations(df.limit(0)).count() == 0


@pytest.mark.parametrize(("roles", "error"), [("sua", None), ("ua", None), ("su", None), ("u", None), ("s", 1), ("au", 0), ("uu", 1), ("suaa", 3), ("uas", 2), ("ux", 1)])
def test_turn_order(spark, roles, error):
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    df = spark.createDataFrame([([names[r] for r in roles],)], "roles array<string>")
    assert df.select(chat.turn_order_error(F.col("roles"), chat.ChatTemplate()).alias("e")).first().e == error


def test_loss_text_is_the_assistants(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a<b"), (1, 2, "user", "q"), (1, 3, "assistant", "c")], "conv_id long, turn long, role string, text string")
    row = chat.format_conversations(df).select(F.filter("segments", lambda s: s["loss"]).alias("l")).first()
    assert [s.text for s in row.l] == ["a<\\b", "c"]


def test_urls(spark):
    given = [
        ("http://WWW.Example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"), ("https://example.com/en/", "example.com", "/en/", "example.com/en/", "block"),
        ("https://a.example.com/en/x?y#z", "a.example.com", "/en/x", "example.com/en/", "block"), ("https://xexample.com/en/", "xexample.com", "/en/", "com/", "allow"),
        ("http://com", "com", "", None, "allow"), ("http://a.net/es/", "a.net", "/es/", "net/es/", "block"), ("http://a.org/x?page=2", "a.org", "/x", None, "block"),
        ("http://a.org/x?page=1", "a.org", "/x", None, "allow"), ("http://a.org/homepage=2", "a.org", "/homepage=2", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
        ("no scheme/login", "", "", None, "block"), ("http://ads.a.org/", "ads.a.org", "/", None, "block"), ("http://x/y://z/ads/", "x", "/y://z/ads/", None, "block"), ("HTTP://É.org?q://", "É.org", "", None, "allow"),
    ]
    rows = [(i, g[0]) for i, g in enumerate(given)] + [(0, given[0][0])]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string").withColumn("token", F.lit(1)).withColumn("n", F.lit(5))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == given[r.page_id][1:], given[r.page_id]
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_index_finds_what_all_rules_find(spark):
    """The rarest token never loses a match against running every rule on every URL."""
    parts = ["page", "ads", "x", "login", "feed", "a.org", "m.b.net", "1", "print", "q.html"]
    made = [(i, f"http://{parts[i % 10]}/{parts[i * 3 % 10]}{'/?^&.'[i % 5]}{parts[i * 7 % 10]}={i % 3}") for i in range(300)]
    rules = [urls.compile_rule(p) for p in urls.PATTERNS]
    got = {r.page_id: r.pattern for r in urls.filter_urls(spark.createDataFrame(made, "page_id long, url string")).collect()}
    for i, u in made:
        hit = max(((r.verdict == "allow", len(r.pattern), r.pattern) for r in rules if re.search(r.regex, u.lower())), default=(0, 0, None))
        assert got[i] == hit[2], u


def measures(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_measures(spark, corpus, clashing, nothing):
    more = spark.createDataFrame([(t,) for t in ("a b c d e a b c d e", "x\nx\n \nx\n", "#$ <b>", "a b c d e f a b c d e g a b c d e", "a\x0bb\x1fc")], "text string")
    for r in quality.with_measures(corpus.select("text").union(more)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measures(r.text)
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    done = quality.judge(clashing, labels).collect()
    assert len(done) == corpus.count() and all(r.kept == (not r.base_failed) for r in done)
    assert quality.judge(nothing, labels).count() == 0


def test_binomial_bound_and_thresholds():
    from math import comb

    for k, n, p in ((0, 50, 0.02), (3, 40, 0.1), (7, 7, 0.5), (0, 0, 0.1)):
        exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(quality.binomial_tail(k, n, p) - exact) < 1e-9
    control = quality.RiskControl(grid_size=3, max_false_rejection=0.05)
    row = {"stratum": "en"} | {f"{s}_{i}_{m}": 0 for s in quality.SCORES for i in range(3) for m in "kb"}
    row |= {"symbol_share_1_b": 50, "symbol_share_2_b": 60, "symbol_share_2_k": 400, "upper_share_0_b": 20, "upper_share_0_k": 1}
    cut = {s: control.cutoffs(s) for s in quality.SCORES}
    sequences = quality.rule_sequences([row], control)
    assert sequences == {"en": [("symbol_share", cut["symbol_share"][1]), ("upper_share", cut["upper_share"][0])]}
    own = lambda *n: [{"stratum": "en", "step": s, "n": k} for s, k in zip((None, 1, 2), n, strict=True)]
    assert quality.proven_rules(sequences, own(900, 5, 5), control) == sequences
    # the second rule's losses count with the first one's
    assert quality.proven_rules(sequences, own(900, 25, 25), control) == {"en": sequences["en"][:1]}
    assert quality.proven_rules(sequences, own(40, 0, 0), control) == {} == quality.proven_rules(sequences, own(900, 60, 0), control)
    assert quality.rule_sequences([], control) == {} and quality.proven_rules({}, [], control) == {}


def test_joint_rejection_stays_within_the_limit(spark):
    """Two rules that each lose good rows: together they stay below the limit on rows that no
    rule was learnt from, in every stratum; a stratum with few labels keeps all."""
    from tests.llm.conftest import prose

    def text(i):
        p = prose(i, 40)
        if i % 5 == 0:
            return " ".join(w + "##" for w in p.split())
        if i % 5 == 1:
            return p.upper()
        return " ".join(w + "##" for w in p.split()) if i % 97 == 3 else p.upper() if i % 89 == 4 else p

    rows = [(i, text(i), None if i % 2 else "en") for i in range(6000)] + [(10_000 + i, text(i), "few") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").cache()
    labels = docs.where("doc_id < 4000 OR doc_id >= 10000").select("doc_id", F.when((F.col("doc_id") % 5).isin(0, 1), 0).otherwise(1).alias("quality"))
    out = {r.doc_id: r for r in quality.judge(docs, labels).select("doc_id", "kept", "broken", "base_failed").collect()}
    assert all(out[10_000 + i].kept for i in range(60) if not out[10_000 + i].base_failed)
    broken = set()
    for odd in (0, 1):
        good = [i for i in range(4000, 6000) if i % 2 == odd and i % 5 > 1]
        bad = [i for i in range(4000, 6000) if i % 2 == odd and i % 5 < 2]
        assert sum(not out[i].kept for i in good) <= 0.05 * len(good) and all(not out[i].kept for i in bad)
        broken |= {b for i in bad for b in out[i].broken}
    assert {"symbol_share", "upper_share"} <= broken


def test_rejection_is_controlled_on_new_rows(spark):
    """Junk with symbols goes; good rows of another draw stay within the allowed share."""
    from tests.llm.conftest import prose

    junk = lambda i: " ".join(w + "###" for w in prose(i, 40).split())
    docs = spark.createDataFrame([(i, junk(i) if i % 4 == 0 else prose(i, 60), "en") for i in range(4000)], "doc_id long, text string, lang string").cache()
    labels = docs.where("doc_id < 3000").select("doc_id", F.when(F.col("doc_id") % 4 == 0, 0).otherwise(1).alias("quality"))
    kept = {r.doc_id for r in quality.judge(docs, labels).where("kept").select("doc_id").collect()}
    new = range(3000, 4000)
    assert not any(i in kept for i in new if i % 4 == 0) and sum(i not in kept for i in new if i % 4) <= 40


def test_digest_query_columns(spark):
    row = chat.op6_chat_format(spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest() and row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
