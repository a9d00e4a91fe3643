import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    """n words, the same for a seed; lines of 12."""
    x, out = seed * 7919 + 17, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 16) % len(WORDS)] + str((x >> 8) % 97))
    return "\n".join(" ".join(out[i : i + 12]) for i in range(0, n, 12))


@pytest.fixture(scope="session")
def corpus(spark):
    """Texts with copies, near copies, shared passages, secrets, nulls, repeated rows and a long one."""
    passage = prose(99, 70)
    base = [prose(i, 80 + 13 * i) for i in range(12)]
    near = base[3].replace(base[3].split()[40], "changed", 1)
    texts = base + [base[2], base[2], near, near.replace("beta", "BETA"), None, "", " \n\t ", "one", "one two", "password=abcdefgh1 x", f"a\n{passage}\nb", f"{passage}\n{prose(50, 30)}", "x " * 9000, "AKIA" + "A1" * 8, "é漢" * 30]
    rows = [(i * 3 % 101, t, ("en", "fr", None)[i % 3], f"s{i % 4}" if i % 5 else None, len(t) if t is not None else None) for i, t in enumerate(texts)]
    rows += [rows[0], rows[16], (None, base[1], "en", "s1", 1), (None, None, None, None, None), (rows[4][0], "another text with this id", "en", "s0", 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def nothing(corpus):
    return corpus.limit(0)


@pytest.fixture(scope="session")
def clashing(corpus):
    """The corpus with columns of names that operators use themselves."""
    from pyspark.sql import functions as F

    return corpus.select("*", *(F.lit("mine").alias(c) for c in ("hash", "n", "sid", "line", "words", "spans", "token", "length", "start", "rank", "bucket", "hit", "runs", "n_words", "kept", "broken", "fingerprint", "anchors", "first", "last", "cluster", "group", "piece", "offset", "root", "node", "_key", "_runs", "_spans", "_new", "_w", "_lines", "_g", "_s", "_f", "_rules", "_found", "_text", "_bucket", "_stratum", "_n_upper")))
