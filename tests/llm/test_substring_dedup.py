import random
from collections import defaultdict

import numpy as np

from arpent.llm import substring_dedup as sd


def plain_chunks(text):
    """The chunks of a text with plain loops: a gear hash byte by byte."""
    data, h, out, last, before, hashes = (text or "").encode(), 0, [], 0, None, []
    for b in data:
        h = ((h << 1) + int(sd.GEAR[b])) & 0xFFFF
        hashes.append(h)
    ends, before = [], None
    for i, h in enumerate(hashes):
        if h < 65536 // sd.RATE and i + 1 >= sd.WINDOW:
            if before is None or i + 1 - before >= sd.SHORTEST:
                ends.append(i + 1)
            before = i + 1
    for end in sorted({*ends, len(data)} - {0}):
        while end - last > sd.LONGEST:
            low = min(range(last + sd.WINDOW, last + sd.LONGEST + 1), key=lambda p: (hashes[p - 1], -p))
            out.append((last, low))
            last = low
        out.append((last, end))
        last = end
    return out


def plain_units(text):
    """(start, end) in bytes of the words of a text; long ones are parted at their own cuts, between characters."""
    data, out, a = (text or "").encode(), [], None
    flat = b" ".join(data.split())
    h, hashes = 0, []
    for b in flat:
        h = ((h << 1) + int(sd.GEAR[b])) & 0xFFFF
        hashes.append(h)
    at, place = 0, 0
    for word in data.split():
        a = data.index(word, at)
        at = a + len(word)
        ends = {len(word)}
        if len(word) > sd.LONG_WORD:
            for i in range(len(word)):
                if hashes[place + i] < 65536 // sd.RATE:
                    p = i + 1
                    while p < len(word) and word[p] & 0xC0 == 0x80:
                        p += 1
                    if sd.WINDOW <= p < len(word):
                        ends.add(p)
        place += len(word) + 1
        begin = 0
        for e in sorted(ends):
            out.append((a + begin, a + e))
            begin = e
    return out


def brute(rows, least=sd.LEAST_WORDS):
    """The same rule with plain loops: chunks as byte strings, windows as tuples of words, sets of ids."""
    where, first = defaultdict(set), {}
    for doc, text in rows:
        for a, b in plain_chunks(text):
            where[(text or "").encode()[a:b]].add(doc)
    near = {}
    for doc, text in sorted(rows):
        data, runs, run = (text or "").encode(), [], None
        for a, b in [*plain_chunks(text), (None, None)]:
            if a is not None and len(where[data[a:b]]) > 1:
                run = (run[0] if run else a, b)
            elif run:
                if run[1] - run[0] >= sd.RUN:
                    runs.append((run[0] - sd.MARGIN, run[1] + sd.MARGIN))
                run = None
        words = plain_units(text) if runs else []
        near[doc] = [(i, words[i][0], words[i + least - 1][1]) for i in range(len(words) - least + 1) if any(a <= words[i][0] and words[i + least - 1][1] <= b for a, b in runs)]
        for _, a, b in near[doc]:
            first.setdefault(b" ".join(data[a:b].split()), doc)
    out = {}
    for doc, text in rows:
        data, spans = (text or "").encode(), []
        for _, a, b in near[doc]:
            if first[b" ".join(data[a:b].split())] != doc:
                gap = data[spans[-1][1] : a].split() if spans and a > spans[-1][1] else []
                spans = [*spans[:-1], (spans[-1][0], b)] if spans and not gap else [*spans, (a, b)]
        out[doc] = ",".join(f"{a}:{b}" for a, b in spans)
    return out


def test_query_equals_plain_loops(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in sd.op1_substring_dedup(spark, sf_dir).collect()}
    want = brute(rows)
    assert {d: r["spans"] for d, r in got.items()} == want
    for doc, text in rows:
        assert got[doc]["text"] == sd.cut_spans(text, [tuple(map(int, s.split(":"))) for s in want[doc].split(",") if s])


def test_chunks_equal_plain_loops():
    rng = random.Random(2)
    texts = ["", "a", "x" * 5000, "ab" * 3000, "日本語テキスト" * 400, "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(3000)), " ".join(str(rng.random()) for _ in range(400)), "lorem ipsum " * 600]
    for text in texts:
        starts, ends, _ = sd.chunks(text)
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == plain_chunks(text)
        _, first, last, shift = sd.units(text)
        assert list(zip((first + shift).tolist(), (last + shift).tolist(), strict=True)) == plain_units(text)


def test_text_without_spaces(spark):
    rng = random.Random(8)
    signs = lambda n: "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(n))
    passage = signs(900)
    rows = [(1, signs(300) + passage + signs(200)), (2, signs(77) + passage + signs(400)), (3, signs(1500))]
    got = {r["doc_id"]: r for r in sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), report=True).collect()}
    assert got[1]["text"] == rows[0][1] and got[3]["text"] == rows[2][1] and got[2]["removed_chars"] >= 800


def test_shifted_passages_are_cut_and_clean_text_stays(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzéü") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(55) for _ in range(40)]
    rows, kept = [], {}
    for i in range(160):
        a, b = prose(rng.randint(20, 60)), prose(rng.randint(20, 60))
        rows.append((i, f"{a} {passages[i % 40]} {b}" if i < 120 else f"{a}\n{b}"))
    got = {r["doc_id"]: r for r in sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), report=True).collect()}
    caught = [i for i in range(40, 120) if got[i]["removed_chars"] > 0]
    assert len(caught) >= 78
    assert all(i % 40 in got[i]["kept_in"] for i in caught)
    assert all(got[i]["text"] == rows[i][1] for i in [*range(40), *range(120, 160)])


def test_odd_rows_and_no_rows(odd, no_docs):
    for docs in (odd, no_docs):
        out = sd.remove_repeats(docs)
        assert out.schema.names == docs.schema.names and out.count() == docs.count()
    long = "same words in a long passage that stands in many documents again and again without any change at all, truly " * 2
    spark = odd.sparkSession
    rows = [(1, long, 7), (2, long, 8), (2, long, 8), (None, long, 9), (3, "x" * 10000, 1), (4, "x" * 10000, 1)]
    out = sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, spans int")).collect()
    assert len(out) == 6 and next(r for r in out if r[0] == 1)["text"] == long
    assert all(len(r["text"]) < len(long) for r in out if r[0] in (2, None)) and all(r["text"] == "x" * 10000 for r in out if r[0] in (3, 4))


def test_shuffled_way_gives_the_same(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = sorted(map(str, sd.remove_repeats(docs).collect()))
    monkeypatch.setattr(sd, "BROADCAST_ROWS", 0)
    assert sorted(map(str, sd.remove_repeats(docs).collect())) == want


def test_chunks_cover_the_text():
    for text in ("", "a", "abc " * 5000, "é" * 9999):
        starts, ends, _ = sd.chunks(text)
        assert (np.diff(np.concatenate([[0], ends])) > 0).all() and (ends[-1:] == len(text.encode())).all() and (starts[1:] == ends[:-1]).all()


def plain_windows(rows, least=sd.LEAST_WORDS):
    """The words of each document that lie in a window of so many words which stands in a document of a smaller id."""
    words = {doc: text.split() for doc, text in rows}
    first = {}
    for doc in sorted(words):
        for i in range(len(words[doc]) - least + 1):
            first.setdefault(tuple(words[doc][i : i + least]), doc)
    out = {doc: set() for doc in words}
    for doc, w in words.items():
        for i in range(len(w) - least + 1):
            if first[tuple(w[i : i + least])] != doc:
                out[doc] |= set(range(i, i + least))
    return out


def test_only_contiguous_passages_are_cut_up_to_their_edges(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    halves, whole = [prose(20) for _ in range(80)], [prose(50) for _ in range(80)]
    rows = [(i, f"{prose(30)} {halves[i]} {prose(30)} {whole[i]}\n{prose(30)}") for i in range(80)]
    # two short passages of two documents side by side are no match; each passage of 50 words is one
    rows += [(100 + i, f"{prose(30)} {halves[i]} {halves[(i + 1) % 80]} {prose(30)}") for i in range(80)]
    rows += [(200 + i, f"{prose(9)}\n{whole[i]} {prose(9)}") for i in range(80)]
    rows += [(300, "la " * 300 + "end"), (301, "so " + "la " * 300)]
    got = {r["doc_id"]: r for r in sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), report=True).collect()}
    at = dict(rows)
    assert all(got[i]["text"] == at[i] for i in [*range(80), *range(100, 180), 300])
    assert all(got[200 + i]["text"] == at[200 + i].replace(whole[i], "") and got[200 + i]["kept_in"] == [i] for i in range(80))
    assert got[301]["text"] == "so  "


def test_query_cuts_what_plain_windows_cut(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want, sure, missed = plain_windows(rows), plain_windows(rows, 50), 0
    for r in sd.op1_substring_dedup(spark, sf_dir).collect():
        data, cut = dict(rows)[r["doc_id"]].encode(), set()
        for a, b in (map(int, s.split(":")) for s in r["spans"].split(",") if s):
            n = len(data[:a].split())
            cut |= set(range(n, n + len(data[a:b].split())))
        assert cut <= want[r["doc_id"]]
        missed += bool(sure[r["doc_id"]] - cut)
    assert missed <= 0.01 * sum(map(bool, sure.values()))


def test_copies_go_whole_and_name_what_keeps_them(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    inner, short, other = prose(60), prose(30), prose(70)
    text = f"{prose(50)} {inner} {prose(50)}"
    rows = [(5, text), (7, text), (7, text), (9, text), (None, text), (2, f"{prose(30)} {inner}"), (3, short), (4, short), (10, other), (11, other), (11, f"{prose(20)} {inner}")]
    for most in (sd.BROADCAST_ROWS, 0):
        sd.BROADCAST_ROWS, held = most, sd.BROADCAST_ROWS
        got = sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), report=True).collect()
        sd.BROADCAST_ROWS = held
        assert len(got) == len(rows)
        whole = [r for r in got if r["doc_id"] in (7, 9, None)]
        assert len(whole) == 4 and all(r["text"] == "" and r["kept_in"] == [2, 5] for r in whole)
        by = {(r["doc_id"], len(r["text"])): r for r in got}
        assert by[5, len(text) - len(inner)]["kept_in"] == [2] and (3, len(short)) in by and (4, len(short)) in by
        assert (10, len(other)) in by and by[11, 0]["kept_in"] == [10]
        assert [r["kept_in"] for r in got if r["doc_id"] == 11 and r["text"]] == [[2]]
