"""Line rules against brute force."""

import re
from collections import Counter

from stridelake.llm import line_rules as L
from tests.llm.fixtures import documents_frame, words_of


def brute_force(rows, limit, min_left):
    def lines(text):
        out = []
        for line in (text or "").split("\n"):
            folded = "".join("0" if c in "0123456789" else c for c in line)
            folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in folded)
            out.append((line, " ".join(words_of(folded))))
        return out

    holders = {}
    for _, host, text in rows:
        for _, folded in lines(text):
            if folded:
                holders.setdefault((host, folded), set()).add(text)
    out = []
    for doc_id, host, text in rows:
        words = words_of(text)
        grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        covered = set()
        for i in range(len(words) - 7):
            if grams[tuple(words[i:i + 8])] > 1:
                covered.update(range(i, i + 8))
        real = [a for a, b in lines(text) if b]
        common = [a for a, b in lines(text) if b and len(holders[host, b]) > limit]
        left = len(words) - sum(len(words_of(a)) for a in common)
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        out.append((doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", " ".join(words))),
                    len(real) - len(set(real)), len(covered), failed, not failed and left >= min_left * len(words),
                    len(real), len(common), left,
                    "\n".join(a for a, b in lines(text) if not (b and len(holders[host, b]) > limit))))
    return sorted(out, key=str)


def table(spark, docs):
    shared = "Read 10 more pages here\n"
    extra = [(1000 + i, shared.replace("10", str(i)) + " ".join(f"w{i}x{j}" for j in range(30 if i % 2 else 4)) + "\n" + shared.upper() * (i % 3),
              None if i % 4 == 0 else "a") for i in range(24)]
    more = spark.createDataFrame(extra, "doc_id long, text string, source string")
    return docs.select("doc_id", "text", "source").unionByName(more).withColumn("key", documents_key())


def documents_key():
    from pyspark.sql import functions as F

    return F.lit(3)


def test_against_brute_force(spark):
    docs = table(spark, documents_frame(spark))
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    for limit, chunk in ((5, 16_000_000), (2, 700)):
        got = L.apply_line_rules(docs, max_documents=limit, with_text=True, chunk_bytes=chunk).collect()
        want = brute_force(rows, limit, 0.5)
        assert sorted((tuple(r) for r in got), key=str) == want
        assert {w[7] for w in want} == {True, False} and any(w[9] for w in want)


def test_copies_are_one_text(spark):
    text = "\n".join(" ".join(f"w{i}{chr(97 + j)}" for j in range(6)) for i in range(8))
    docs = spark.createDataFrame([(i, text, "h") for i in range(50)], "doc_id long, text string, source string")
    assert all(r["kept"] for r in L.apply_line_rules(docs, max_documents=10).collect())


def test_a_line_of_a_third_of_all_documents_stays_small_everywhere():
    chunks, buckets, most = 60, 8, 6
    sent = []
    for c in range(chunks):
        chunk = L.Chunk()
        for i in range(30):
            chunk.add(i, "h", ("the shared line\n" if i % 3 == 0 else "") + f"own words {chr(97 + c % 26)} {i * 'x'}z{c * 'y'}")
        sent += [r for r in chunk.send(c, 1, buckets, most, False) if r[0] >= 0]
    groups = {}
    for key, src, blob in sent:
        assert L.unpack(blob)["n"].max() <= most  # ten texts of each chunk have the line
        groups.setdefault(key, []).append((key, src, blob))
    assert 1 < len(groups) <= buckets and max(map(len, groups.values())) < chunks / 2
    up = [tuple(r.values()) for g in groups.values()
          for r in L.merger(1, buckets, most)(L.block_table(g)).to_pylist()]
    assert {k for k, _, _ in up} == {buckets} and len(up) == len(groups)
    assert all(L.unpack(b)["n"].max() <= most for _, _, b in up)
    down = L.total(most - 1)(L.block_table(up)).to_pylist()
    assert all(L.unpack(r["blob"])["common"].sum() == 1 for r in down)
    for r in down:
        told = L.tell_chunks(L.block_table(groups[r["key"]]), L.block_table([tuple(r.values())])).to_pylist()
        assert len(told) == len(groups[r["key"]]) and all(L.unpack(x["blob"])["common"].sum() == 1 for x in told)


def test_limit_is_exact_across_chunks(spark):
    for texts, common in ((7, 0), (8, 1)):
        rows = [(i, f"the same line here\n{chr(97 + i % texts) * 40}", "h") for i in range(3 * texts)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        got = L.apply_line_rules(docs, max_documents=7, chunk_bytes=100).collect()
        assert {r["n_common_lines"] for r in got} == {common} and len(got) == 3 * texts


def test_columns_and_empty_table(spark):
    docs = documents_frame(spark)
    assert "clean_text" not in L.apply_line_rules(docs).columns
    assert L.kept_documents(L.apply_line_rules(docs)).count() < docs.count()
    assert L.apply_line_rules(docs.limit(0)).count() == 0
