import numpy as np
import pytest

from fieldlake.llm import repeats
from fieldlake.llm.repeats import cut_pieces, least_owner, remove_repeats, whole_characters


def brute(rows, length):
    """Per (doc_id, text): kept bytes and removed runs."""
    first, found = {}, []
    rows = [(i if i is not None else 1 << 62, (t or "").encode()) for i, t in rows]
    for doc, data in rows:
        for at in range(len(data) - length + 1):
            gram = data[at : at + length]
            first[gram] = min(first.get(gram, doc), doc)
    for doc, data in rows:
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if first[data[at : at + length]] < doc:
                gone[at : at + length] = b"\1" * length
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        found.append((doc if doc != 1 << 62 else None, bytes(b for b, g in zip(data, gone) if not g), runs))
    return sorted(found, key=str)


def mine(df):
    rows = [(r.doc_id, bytes(r.kept), len(r.spans)) for r in df.collect()]
    return sorted(rows, key=str)


@pytest.mark.parametrize("length", [50, 12, 230, 1000])
def test_same_as_brute_force(docs, prose, length):
    rows = list(enumerate(prose)) + [(100 + n, text) for n, text in enumerate(prose[:5])]
    rows += [(7, None), (8, ""), (200, "a" * 3000), (201, "b" + "a" * 500), (202, "x" * 49), (203, "x" * 49)]
    rows += [(None, prose[0]), (None, prose[0]), (3, prose[1]), (205, prose[2] + "é" * 200), (206, "é" * 120)]
    assert mine(remove_repeats(docs(rows), length)) == brute(rows, length)


def test_many_shards_and_chunks(docs, prose, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_SYMBOLS", 300)
    strings = sorted({t.encode()[k : k + 70] for t in prose for k in range(0, len(t) - 70, 37)})
    owner = np.arange(len(strings))[::-1].copy()
    got = least_owner(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]), owner, 50)
    best = {}
    for s, o in zip(strings, owner):
        for at in range(len(s) - 49):
            best[s[at : at + 50]] = min(best.get(s[at : at + 50], o), o)
    assert got.tolist() == [best[s[at : at + 50]] for s in strings for at in range(len(s) - 49)]


def test_empty_table(docs):
    assert remove_repeats(docs([]), 50).count() == 0


def test_cuts_leave_valid_text(docs):
    text = "é" * 100
    found = remove_repeats(docs([(1, "a" + text), (2, "b" + text + "z")]), 51, ("ids",))
    kept = {r.doc_id: r.text for r in whole_characters(found).collect()}
    assert kept[1] == "a" + text and kept[2].startswith("b") and kept[2].endswith("z")


def test_only_starts_of_whole_strings_are_interleaved(prose, monkeypatch):
    rounds = []
    one = repeats.interleave
    monkeypatch.setattr(repeats, "interleave", lambda *given: rounds.append(one(*given)) or rounds[-1])
    strings = sorted({t.encode()[k : k + 70] for t in prose for k in range(0, len(t) - 70, 37)})
    least_owner(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]), np.arange(len(strings)), 50)
    assert [len(rows) for rows, _ in rounds] == [21 * len(strings)]


@pytest.mark.parametrize("chunk, piece", [(1 << 17, 48), (37, 5)])
def test_pieces_hold_every_start_once(prose, monkeypatch, chunk, piece):
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    monkeypatch.setattr(repeats, "PIECE", piece)
    texts = [b"", *(t.encode() for t in prose[:4]), b"", b"x" * 49, b"a" * 300, prose[0].encode(), b"z" * 50, b""]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = cut_pieces(np.frombuffer(b"".join(texts), np.uint8), offsets, 50)
    starts = [(s + k, t, a) for s, n, a, t in zip(*(x.tolist() for x in (got.start, got.count, got.anchor, got.text))) for k in range(n)]
    assert [(s, t) for s, t, _ in starts] == [(offsets[n] + k, n) for n, t in enumerate(texts) for k in range(len(t) - 49)]
    assert got.count.max() <= piece
    anchors = {}
    for start, text, anchor in starts:
        whole = texts[text][start - offsets[text] :][:50]
        assert anchors.setdefault(whole, anchor) == anchor
