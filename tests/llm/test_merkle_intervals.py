import hashlib
import zlib

from textlab.llm import merkle_intervals as M


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest(*[field(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def climb(tree, at, start):
    """Sibling digests and the digest reached from ``start`` in place ``at``."""
    siblings = []
    for level in tree[:-1]:
        first = at // 8 * 8
        before, after = level[first:at], level[at + 1:first + 8]
        siblings += before + after
        start, at = digest(*before, start, *after), at // 8
    return siblings, start


def brute(rows):
    """The contract, row by row in one process."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[g] = levels([leaf(r, r["text"]) for r in groups[g]])
    upper = levels([trees[g][-1][0] for g in order])
    out = []
    for g in order:
        for i, r in enumerate(groups[g]):
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            below, _ = climb(trees[g], i, trees[g][0][i])
            above, _ = climb(upper, order.index(g), trees[g][-1][0])
            _, sub = climb(trees[g], i, leaf(r, text))
            _, root = climb(upper, order.index(g), sub)
            out.append((r["doc_id"], trees[g][0][i], trees[g][-1][0], upper[-1][0], digest(*below, *above), root,
                        root == upper[-1][0]))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SCHEMA = "text string, doc_id long, extra string, lang string, source string, n_chars long, lo long, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(t, d, "x", g, s, n, 7, "clash") for d, s, g, n, t in rows], SCHEMA)


def test_equals_brute_force_with_edges(spark):
    rows = [(i, f"s{i % 3}", "en", 9, f"Text {i} É") for i in range(75)]            # two levels and a run of three
    rows += [(i, "s", "de", 1, "Some Text") for i in range(1000, 1009)]              # the last run has one leaf
    rows += [(3, None, "fr", None, "Lone")]                                          # a lone leaf
    rows += [(None, None, None, None, None), (None, "a", None, 2, ""), (6, "a", None, 2, "A" * 3_000_000)]
    rows += [(8, "a", "", 2, "B")] * 17 + [(8, "a", "", 2, "C")] * 9                 # repeated rows and a repeated id
    rows += [(i, "a", f"z{i}", 1, f"T{i}") for i in range(9)]                        # more languages than one run holds
    df = frame(spark, rows).repartition(5)
    made = M.proofs(M.manifest(df))
    assert made.columns == COLUMNS
    got = sorted((tuple(r) for r in made.collect()), key=repr)
    assert got == brute([r.asDict() for r in df.collect()])
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_small_tables(spark):
    df = frame(spark, [(1, "s", "en", 1, "One")])
    (r,) = M.proofs(M.manifest(df)).collect()
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == digest()
    assert M.proofs(M.manifest(df.limit(0))).collect() == []


def test_path_proves_each_leaf(spark, sf_dir):
    """Folding an untampered leaf along its path gives the root; the whole table equals brute force."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = M.manifest(docs)
    rows = made.limit(50).collect()
    for r in rows:
        acc = r["leaf"]
        for s in r["path"]:
            acc = digest(s["before"], acc, s["after"])
        assert acc == r["root"]
    got = sorted((tuple(r) for r in M.op11_merkle_intervals(spark, sf_dir).collect()), key=repr)
    assert got == brute([r.asDict() for r in docs.collect()])
