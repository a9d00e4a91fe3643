"""N-gram Jaccard join by a token-group matrix.

Each document is the set of its distinct word shingles; equal sets are one. Before any link is
known, all sets are partitioned into groups of at most 64: those of a size class with the same
smallest minhash, which similar sets mostly share, stand together, and sets that share it with
none are pooled by its first bits. The matrix stores the union of each group's tokens, as far as
they can decide (a set's rarest ones, its prefix), each with the bits of the members that have
it and the least and greatest size they can overlap with. Each set is then a query: the tokens
it has in common with a group's union, of sizes that allow a link, bound its overlap with every
member, and only groups that reach the bound are opened. In an opened group the bits are added
up, and members with enough tokens in common are compared, by bitmaps first and then token by
token.

A group of copies with edits may hold a third of all sets, and comparing all of its pairs would
be quadratic. So sets that share minhash bands meet the most typical set of the band first, and
those linked to it form a cluster. Sets of one cluster are linked already, so the matrix serves
only pairs of different clusters, and tokens that a single cluster has are left out of it. How
many of those a set has bounds what it can have in common with any set of another cluster, which
decides on each pair of an opened group before it is made. All links between sets of different
clusters are found that way, so the components are exact.

Shingles are 64-bit hashes of their words. Only their order needs frequencies: counts of all
shingles of all documents in 2**18 hash buckets, a table of fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticeworks.llm.common import MAX_BROADCAST_KEYS, free_shuffles, fresh, row_key, scratch, table, unused, written
from noticeworks.llm.components import components

BITS = 18
BUCKETS = 1 << BITS
_BUCKET = np.uint64(64 - BITS)
#: Common tokens at least that a set must show with a group in its prefix to open it, where
#: all sets are large enough to have them; prefixes are longer by as many, less one.
SHOWN, LARGE = 3, 30
#: Members of a group: one bit each of a long.
GROUP = 64
_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


@dataclass(frozen=True)
class Threshold:
    """Shingles of ``words`` words; two sets link when den * intersection >= num * union. Groups
    have at most ``group`` members, 64 or less."""

    words: int = 5
    num: int = 80
    den: int = 100
    group: int = GROUP


class _Words(dict):
    """Hashes of words seen; forgets them all after a million."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, words: int, known: _Words) -> np.ndarray:
    """Sorted distinct hashes of the shingles; of all words as one where there are fewer."""
    split = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    n = len(split)
    if not n:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(known.__getitem__, split), np.uint64, n)
    k = min(words, n)
    h = ids[: n - k + 1] + np.uint64(k)
    for j in range(1, k):
        h = (h ^ (h >> np.uint64(29))) * _ODD[0] + ids[j : n - k + 1 + j]
    h = (h ^ (h >> np.uint64(32))) * _ODD[1]
    return np.unique(h ^ (h >> np.uint64(29)))


def bucket_counts(docs: DataFrame, words: int) -> np.ndarray:
    """In how many documents shingles of each bucket occur, over all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, total = _Words(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            found = [shingle_set(text, words, known) for text in batch["text"]]
            if found:
                total += np.bincount((np.concatenate(found) >> _BUCKET).astype(np.int64), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    found = docs.select("text").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BUCKETS, np.int64)
    for bucket, n in found:
        counts[bucket] = n
    return counts


def document_sets(docs: DataFrame, rule: Threshold) -> DataFrame:
    """doc, _key, n (shingles), sid (the set's 128-bit hash, null for none), bands, score, least,
    prefix.

    ``prefix``: the tokens that can be the first common ones with a linked set, rarest first.
    ``bands``: four pairs of minhashes; ``least`` is the first of them. ``score``: how common its rarest tokens are; in a group
    of copies with edits the one nearest to the original scores highest.
    """
    counts = docs.sparkSession.sparkContext.broadcast(bucket_counts(docs, rule.words))
    words, num, den = rule.words, rule.num, rule.den

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, freq = _Words(), counts.value
        for batch in batches:
            rows = []
            for doc, key, text in zip(batch["doc"], batch["_key"], batch["text"], strict=True):
                doc = None if pd.isna(doc) else int(doc)
                tokens = shingle_set(text, words, known)
                n = len(tokens)
                if not n:
                    rows.append((doc, key, 0, None, [], 0.0, 0, []))
                    continue
                sid = xxhash.xxh3_128_hexdigest(tokens.tobytes())
                least = (tokens[None, :] * _ODD[:, None]).min(axis=1)
                bands = [f"{i}:{int(least[2 * i]):x}:{int(least[2 * i + 1]):x}" for i in range(4)]
                often = freq[(tokens >> _BUCKET).astype(np.int64)]
                length = n - -(-num * n // den) + (SHOWN if n >= LARGE else 1)
                order = np.lexsort((tokens, often))[:length]
                rows.append((doc, key, n, sid, bands, float(np.log2(often[order]).mean()), int(least[:1].view(np.int64)[0]), tokens[order].view(np.int64).tolist()))
            yield pd.DataFrame(rows, columns=["doc", "_key", "n", "sid", "bands", "score", "least", "prefix"]).astype({"doc": "Int64"})

    return docs.select(F.col("doc_id").alias("doc"), row_key().alias("_key"), "text").mapInPandas(
        sets, "doc long, _key string, n long, sid string, bands array<string>, score double, least long, prefix array<bigint>"
    )


def _sorted_id(doc: Column, sid: Column) -> Column:
    """A string that sorts by doc (nulls last), then by set."""
    high = F.lit(-(1 << 63)).cast("long")
    return F.concat(F.coalesce(F.lpad(F.hex(doc.bitwiseXOR(high)), 16, "0"), F.lit("~")), F.lit("/"), sid)


def _doc_of(node: Column) -> Column:
    number = F.conv(F.substring(node, 1, 16), 16, -10).cast("long")
    return F.when(~node.startswith("~"), number.bitwiseXOR(F.lit(-(1 << 63)).cast("long")))


def bitmap(tokens: np.ndarray) -> bytes:
    """One of 8 to 16 bits per token set by each token's first bits."""
    size = max(6, int(8 * len(tokens) - 1).bit_length())
    bits = np.zeros(1 << size, np.uint8)
    bits[(tokens >> np.uint64(64 - size)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of fewer bytes, where a bit stands for the bits beside each other that it had."""
    while len(bits) > size:
        bits = np.packbits(np.unpackbits(bits).reshape(-1, 2).any(axis=1))
    return bits


def most_common(a: bytes, na: int, b: bytes, nb: int) -> int:
    """The most tokens that two sets with these bitmaps can have in common: a bit that only one
    has is a token that the other lacks."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    x, y = _folded(x, size), _folded(y, size)
    return min(na - int(np.bitwise_count(x & ~y).sum()), nb - int(np.bitwise_count(y & ~x).sum()))


def token_sets(needed: DataFrame, sets: DataFrame, docs: DataFrame, rule: Threshold) -> DataFrame:
    """sid, n, bits and tokens of the needed sids, each cut again from its representative's text."""
    keys = written(sets.select("sid", "_key").join(needed.distinct(), "sid", "left_semi"), "keys")
    if keys.count() <= MAX_BROADCAST_KEYS:
        keys = F.broadcast(keys)
    texts = docs.select(row_key().alias("_key"), "text").join(keys, "_key").select("sid", "text")
    words = rule.words

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Words()
        for batch in batches:
            found = [shingle_set(t, words, known) for t in batch["text"]]
            yield pd.DataFrame({"sid": batch["sid"], "n": [len(x) for x in found], "bits": [bitmap(x) for x in found], "tokens": [x.tobytes() for x in found]})

    return written(texts.mapInPandas(cut, "sid string, n long, bits binary, tokens binary"), "tokens")


def _with_both(pairs: DataFrame, tokens: DataFrame, *columns: str) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(tokens.select(F.col("sid").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns)), side)
    return pairs


def compared(pairs: DataFrame, tokens: DataFrame, rule: Threshold) -> DataFrame:
    """The pairs of sids (a, b) that link, token by token."""
    num, den = rule.num, rule.den

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for ta, tb in zip(batch["tokens_a"], batch["tokens_b"], strict=True):
                x, y = np.frombuffer(ta, np.uint64), np.frombuffer(tb, np.uint64)
                merged = np.concatenate((x, y))
                merged.sort()
                common = int(np.count_nonzero(merged[1:] == merged[:-1]))
                good.append(den * common >= num * (len(x) + len(y) - common))
            yield batch.loc[good, ["a", "b"]]

    return _with_both(pairs, tokens, "tokens").mapInPandas(compare, "a string, b string")


def linked(pairs: DataFrame, sets: DataFrame, docs: DataFrame, rule: Threshold) -> DataFrame:
    """The pairs of sids (a, b) whose sets link. Pairs first meet the sets' bitmaps, which bound
    what they can have in common, and those that pass the token sets, by joins that adaptive
    execution can split."""
    with scratch(docs.sparkSession):
        pairs = written(pairs, "pairs")
        free_shuffles(docs.sparkSession)
        tokens = token_sets(pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))), sets, docs, rule)
        num, den = rule.num, rule.den

        def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                good = []
                for a, m, b, n in zip(batch["bits_a"], batch["n_a"], batch["bits_b"], batch["n_b"], strict=True):
                    common = most_common(a, m, b, n)
                    good.append(den * common >= num * (m + n - common))
                yield batch.loc[good, ["a", "b"]]

        near = _with_both(pairs, tokens, "n", "bits").mapInPandas(bound, "a string, b string")
        return written(compared(near, tokens, rule), "links", kept=True)


def _compatible(x: Column, y: Column, rule: Threshold) -> Column:
    return F.least(x, y) * rule.den >= F.greatest(x, y) * rule.num


def clusters(sets: DataFrame, docs: DataFrame, rule: Threshold) -> tuple[DataFrame, DataFrame]:
    """Links between sets and the most typical one of a band they share, and (sid, cluster)."""
    banded = sets.select("sid", "n", "score", F.explode("bands").alias("band"))
    typical = banded.groupBy("band").agg(F.max(F.struct("score", "sid", "n")).alias("p"), F.count("*").alias("k")).where("k > 1")
    pairs = banded.join(typical.select(fresh(F.col("band")).alias("band"), "p"), "band").where(F.col("sid") != F.col("p.sid")).where(_compatible(F.col("n"), F.col("p.n"), rule))
    links = linked(pairs.select(F.col("sid").alias("a"), F.col("p.sid").alias("b")).distinct(), sets, docs, rule)
    return links, components(links).select(F.col("node").alias("sid"), F.col("root").alias("cluster"))


def grouped(sets: DataFrame, rule: Threshold) -> DataFrame:
    """sid, group, member (its place there, from 0): groups of similar sets, of bounded size.

    ``sets``: sid, n, least (a minhash). Sizes of one class are within the threshold's ratio.
    Counts by class and minhash are combined before they are shuffled and joined back by a join
    that adaptive execution can split; sets are numbered within equal parts of a key.
    """
    size = F.floor(F.log(F.col("n").cast("double")) / math.log(rule.den / rule.num + 1e-9)).cast("int")
    keyed = sets.select("sid", size.alias("class"), "least")
    counts = keyed.groupBy("class", "least").agg(F.count("*").alias("k"))
    lone = counts.where("k = 1").groupBy("class").agg(F.count("*").alias("alone"))
    counts = counts.join(F.broadcast(lone), "class", "left")  # a row per size class: their number is a logarithm
    half = rule.group // 2
    pools = F.greatest(F.lit(1), F.ceil(F.col("alone") / half))
    pooled = F.concat_ws("/", F.lit("pool"), "class", F.pmod(F.xxhash64("least"), pools))
    parts = F.greatest(F.lit(1), F.ceil(F.col("k") / half))
    spread = F.concat_ws("/", "class", "least", F.pmod(F.xxhash64("sid"), parts))
    counts = counts.select(F.col("class").alias("_class"), F.col("least").alias("_least"), "k", "alone")
    placed = keyed.join(counts, (F.col("class") == F.col("_class")) & (F.col("least") == F.col("_least"))).select("sid", F.when(F.col("k") == 1, pooled).otherwise(spread).alias("part"))
    # parts hold half a group's sets on average and rarely more than a group; what is beyond starts another
    nth = F.row_number().over(W.partitionBy("part").orderBy("sid")) - 1
    numbered = placed.select("sid", "part", nth.alias("nth"))
    return numbered.select("sid", F.xxhash64("part", F.floor(F.col("nth") / rule.group)).alias("group"), (F.col("nth") % rule.group).cast("int").alias("member"))


def token_postings(sets: DataFrame) -> DataFrame:
    """A row per set, by its group and member, and token of its prefix: cluster, n, group, member,
    i, token; only tokens that more than one cluster has."""
    postings = sets.select("cluster", F.col("n").cast("long").alias("n"), "group", "member", F.posexplode("prefix").alias("i", "token"))
    met = postings.groupBy("token").agg(F.min("cluster").alias("c"), F.max("cluster").alias("d")).where("c <> d")
    return postings.join(met.select((F.col("token") + F.lit(0)).alias("token")), "token", "left_semi")


def token_group_matrix(postings: DataFrame) -> DataFrame:
    """A row per token and group that has it: token, group, low and high (sizes of the members
    that have it), reach (the largest set that they can overlap enough with) and members (their bits)."""
    bit = F.expr("shiftleft(1L, member)")
    return postings.groupBy("token", "group").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("reach").alias("reach"), F.bit_or(bit).alias("members"))


def opened_groups(postings: DataFrame, matrix: DataFrame, rule: Threshold) -> DataFrame:
    """Queries (by own group and member, ``own`` and ``me``) and the groups that their bound opens:
    own, me, cluster, n, group, hits (bits of the members with enough tokens in common).

    The smaller set of a link is the query (at the same size both are), so only places in its
    prefix count from which it can still overlap enough with a set as large as itself.
    """
    num, den = rule.num, rule.den
    q = postings.where("reach >= n").select("token", F.col("group").alias("own"), F.col("member").alias("me"), "cluster", "n", "reach")
    m = matrix.select(F.col("token").alias("_token"), "group", "low", "high", F.col("reach").alias("_reach"), "members")
    bound = (F.col("n") <= F.col("high")) & (F.col("n") <= F.col("_reach")) & (F.col("low") <= F.col("reach")) & (F.col("n") * den >= F.col("low") * num)
    met = q.join(m, (F.col("token") == F.col("_token")) & bound)
    shown = met.groupBy("own", "me", "cluster", "n", "group").agg(F.count("*").alias("shown"), F.collect_list("members").alias("masks"))
    shown = shown.where((F.col("shown") >= SHOWN) | (F.col("n") < LARGE))  # a query isn't larger than what it links with
    none = F.lit(0).cast("long")
    # bits seen at least once, twice, three times: as many as SHOWN
    begin = F.struct(none.alias("once"), none.alias("twice"), none.alias("thrice"))
    seen = F.aggregate(
        "masks",
        begin,
        lambda a, x: F.struct(
            a["once"].bitwiseOR(x).alias("once"), a["twice"].bitwiseOR(a["once"].bitwiseAND(x)).alias("twice"), a["thrice"].bitwiseOR(a["twice"].bitwiseAND(x)).alias("thrice")
        ),
    )
    counted = shown.select("own", "me", "cluster", "n", "group", seen.alias("seen"))
    hits = F.when(F.col("n") < LARGE, F.col("seen.once")).otherwise(F.col("seen.thrice"))
    return counted.select("own", "me", "cluster", "n", "group", hits.alias("hits")).where("hits <> 0")


def group_pairs(sets: DataFrame, rule: Threshold) -> DataFrame:
    """Pairs of sids (a, b) of different clusters from opened groups. ``sets``: sid, n, prefix,
    cluster, group, member."""
    num, den = rule.num, rule.den
    # the largest set that can overlap enough when one of its first common tokens is at i
    spare = F.when(F.col("n") >= LARGE, SHOWN - 1).otherwise(0)
    reach = F.floor(((F.col("n") - F.col("i") + spare) * (num + den)) / num).cast("long") - F.col("n")
    # written, as what follows reads it three times, each with other columns
    postings = written(token_postings(sets).withColumn("reach", reach).drop("i"), "postings")
    free_shuffles(sets.sparkSession)
    met = postings.groupBy("group", "member").agg(F.count("*").alias("met"))
    # the most tokens that a set can have in common with one of another cluster: those of its
    # prefix that no other cluster has are missing there
    most = F.col("n") - F.size("prefix") + F.col("met")
    known = sets.join(met, ["group", "member"]).select("sid", "group", "member", "cluster", "n", most.alias("most"))
    me = known.select(F.col("group").alias("own"), F.col("member").alias("me"), F.col("sid").alias("x"), F.col("most").alias("most_x"))
    enough = F.col("most_x") * (num + den) >= 2 * num * F.col("n")  # with a set of its own size or more
    opened = opened_groups(postings, token_group_matrix(postings), rule).join(me, ["own", "me"]).where(enough)
    # a group's members, 64 at most, meet the query as a whole; pairs are made of those that can link
    member = F.struct("member", F.col("sid").alias("y"), "cluster", "n", "most")
    whole = known.groupBy("group").agg(F.collect_list(member).alias("members"))

    def can_link(m: Column) -> Column:
        hit = (F.getbit("hits", m["member"]) == 1) & (m["cluster"] != F.col("cluster")) & (F.col("n") <= m["n"])
        return hit & _compatible(F.col("n"), m["n"], rule) & (F.least(F.col("most_x"), m["most"]) * (num + den) >= num * (F.col("n") + m["n"]))

    pairs = opened.join(whole, "group").select("x", F.explode(F.filter("members", can_link)["y"]).alias("y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def similar_components(docs: DataFrame, rule: Threshold | None = None) -> DataFrame:
    """One row per document: doc_id, _key, n_shingles, component_id.

    The component is the smallest doc_id reachable by links between texts, its own included.
    Null and empty texts and those without words have no shingles and are alone. Rows equal in
    doc_id and text get a row each. A null doc_id is greater than all others, so a component of
    such rows alone has a null id. Columns other than doc_id and text are ignored.
    """
    rule = rule or Threshold()
    docs = docs.select("doc_id", "text")
    with scratch(docs.sparkSession):
        with scratch(docs.sparkSession):
            rows = written(document_sets(docs, rule), "documents")
            first = F.struct(F.col("doc").isNull(), "doc", "_key")
            sets = rows.where("sid IS NOT NULL").groupBy("sid").agg(F.min(first).alias("f"), *(F.first(c).alias(c) for c in ("n", "bands", "score", "least", "prefix")))
            name = _sorted_id(F.col("f.doc"), F.col("sid"))
            sets = written(sets.select(name.alias("sid"), F.col("sid").alias("hash"), F.col("f._key").alias("_key"), "n", "bands", "score", "least", "prefix"), "sets", kept=True)
            rows = written(rows.select("doc", "_key", "n", "sid"), "rows", kept=True)
        free_shuffles(docs.sparkSession)
        groups = grouped(sets, rule)
        links, clustered = clusters(sets, docs, rule)
        inside = sets.select("sid", "n", "prefix").join(groups, "sid").join(clustered, "sid", "left")
        inside = written(inside.select("sid", "n", "prefix", "group", "member", F.xxhash64(F.coalesce("cluster", "sid")).alias("cluster")), "groups")
        free_shuffles(docs.sparkSession)
        more = linked(group_pairs(inside, rule), sets, docs, rule)
        roots = components(links.unionByName(more))
        named = sets.select("sid", "hash").join(roots, F.col("sid") == F.col("node"), "left").select(fresh(F.col("hash")).alias("hash"), _doc_of(F.coalesce("root", "sid")).alias("component_id"))
        joined = rows.select("doc", "_key", "n", F.coalesce("sid", "_key").alias("hash")).join(named, "hash", "left")
        component = F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component_id"))
        found = joined.select(F.col("doc").alias("doc_id"), "_key", F.col("n").alias("n_shingles"), component.alias("component_id"))
        return written(found, "found", kept=True)


def keep_one(docs: DataFrame, rule: Threshold | None = None) -> DataFrame:
    """docs with one document of each component: the one with its smallest doc_id.

    Of rows with that doc_id and different texts the smallest key of content stays; rows equal
    in doc_id and text are one document and stay together. Documents without words all stay.
    An empty table gives an empty result; columns of any name come back as they were.
    """
    (key,) = unused(docs, "_key")
    found = similar_components(docs, rule)
    going = found.where("n_shingles > 0")
    first = going.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key")).alias("f"))
    stay = first.select(F.col("f._key").alias(key)).unionByName(found.where("n_shingles = 0").select(F.col("_key").alias(key))).distinct()
    return docs.withColumn(key, row_key()).join(stay, key, "left_semi").select(*docs.columns)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by shingles of three words at 0.9."""
    return similar_components(table(spark, sf_dir, "documents"), Threshold(3, 90, 100)).drop("_key")


OP4_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w] ELSE [w[i:i+2] FOR i IN range(1, len(w) - 1)] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.d WHERE r.c < l.b),
m AS (SELECT d, min(c) AS c FROM r GROUP BY d)
SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id FROM documents LEFT JOIN n USING (doc_id) JOIN m ON d = doc_id"""
