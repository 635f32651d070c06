import hashlib
from collections import defaultdict

import pytest

from downfold.llm import exact_dedup, line_dedup
from downfold.llm.components import components
from llm.texts import documents, fold, rows, table

LONG = "abcdefghij" * 40


def brute_exact(given):
    groups = defaultdict(list)
    for doc_id, text in given:
        groups[fold(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max(ids, key=lambda d: (d is not None, d))
        sha = hashlib.sha256(text.encode()).hexdigest()
        left = 1
        for doc_id in sorted(ids, key=lambda d: (d is not None, d), reverse=True):
            kept = doc_id == keep and left == 1
            left -= kept
            out.append((doc_id, keep, len(ids), kept, sha))
    return sorted(out, key=repr)


EXACT = [
    (1, "Same Text"), (2, "same text"), (3, "SAME TEXT "), (4, None), (5, ""), (6, LONG), (7, LONG.upper()), (8, LONG + "x"),
    (9, "x" + LONG), (10, LONG[:-1]), (11, "É"), (12, "é"), (13, "🙂" * 30), (14, "🙂" * 30), (2, "same text"), (None, "same text"),
    (15, LONG * 2), (16, LONG * 2), (17, LONG + LONG[::-1]), (18, LONG[::-1] + LONG), (None, "only null"), (19, "a\r\nb"), (20, "a\nb"),
]


@pytest.mark.parametrize("block", [1, 7, 64, 4096])
def test_exact_duplicates(spark, block):
    given = EXACT if block > 1 else [g for g in EXACT if g[1] is None or len(g[1]) < 40]
    assert rows(exact_dedup.exact_duplicates(documents(spark, given, extra=True), block)) == brute_exact(given)


def test_exact_duplicates_of_a_table_and_of_nothing(spark):
    docs = table(spark, "0.001", "documents")
    got = rows(exact_dedup.exact_duplicates(docs, 100))
    assert got == brute_exact([(r.doc_id, r.text) for r in docs.collect()])
    assert rows(exact_dedup.exact_duplicates(documents(spark, []))) == []


def brute_lines(given, min_chars=20, min_docs=3):
    key = lambda line: fold(line.strip(" \t\n\x0b\x0c\r"))
    rank = lambda d: -(2**63) if d is None else d
    holders = defaultdict(set)
    for doc_id, text in given:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(rank(doc_id))
    out = []
    for doc_id, text in given:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or max(holders[key(x)]) == rank(doc_id)]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


A, B = "a line that many documents hold", "  Another Line, of which there are a few\t"
LINES = [
    (1, f"{A}\nown words\n{A.upper()} "), (2, f"{A}"), (3, f"x\n{A}\n{A}\ny"), (4, f"{B}\n{B.strip()}"), (5, f"\n{B.lower()}\n"), (6, f"{B}\r\n{A} "),
    (7, None), (8, ""), (9, "\n\n"), (10, "short\nshort"), (11, "short"), (12, "short"), (13, f"é{A}"), (14, f"é{A}"),
    (6, f"{A}\nagain"), (None, f"{A}\nnull id"), (None, f"{A}\nother null id"), (15, "nineteen characters"), (16, "nineteen characters"),
    (17, "nineteen characters"), (18, "n\x0bineteen characters"), (19, " " + A), (20, "\n".join([A + "z"] * 200)), (21, A + "z"), (22, A + "z\nq"),
]


@pytest.mark.parametrize("salts", [1, 3, 256])
def test_lines(spark, salts):
    assert rows(line_dedup.dedup_lines(documents(spark, LINES, extra=True), salts=salts)) == brute_lines(LINES)


def test_lines_repeated_rows_are_one_document(spark):
    given = [(1, A), (1, A), (1, A), (2, A)]
    assert rows(line_dedup.dedup_lines(documents(spark, given))) == brute_lines(given)
    assert all(r[2] == 0 for r in brute_lines(given))


def test_lines_of_a_table_and_of_nothing(spark):
    docs = table(spark, "0.001", "documents")
    assert rows(line_dedup.dedup_lines(docs)) == brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert rows(line_dedup.dedup_lines(documents(spark, []))) == []


def test_bitmaps_hold_only_words_with_drops(spark):
    given = [(n, "\n".join(["own line %d %d" % (n, k) for k in range(300)] + [A])) for n in range(4)]
    bitmaps = line_dedup.keep_bitmaps(documents(spark, given)).collect()
    assert sorted(r.doc for r in bitmaps) == [0, 1, 2]
    assert all([(w.word, w.bits) for w in r.words] == [(300 // 64, 1 << 300 % 64)] for r in bitmaps)


@pytest.mark.parametrize(
    "links",
    [[], [(1, 1)], [(1, 2)], [(n, n + 1) for n in range(40)], [(0, n) for n in range(1, 30)], [(n, 99) for n in range(30)] + [(200, 201), (201, 202)]],
)
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    label = {x: x for link in links for x in link if link[0] != link[1]}
    for _ in label:
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert rows(components(df)) == sorted(label.items(), key=repr)
