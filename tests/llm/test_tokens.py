import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wattframe.llm import packing, simple8b, token_counts, token_files
from wattframe.llm.queries import TOKENIZER
from wattframe.llm.tokens import Encoder, PartTable, part_keys

import public_tokenizers

LIBRARY = Tokenizer.from_file(TOKENIZER)
SIGNS = [" ", "  ", "\n", " \n", "\t", "a", "Word", "é", "'s", "'ll", "12", ".", "...", "<|endoftext|>", "​", "\x1c", "\x85"]
SIGNS += ["日本", "🙂", "　", "_", "\r\n", "\x00", "word,", "|", "endoftext|>", "x" * 30, "(", '"']


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SIGNS), max_size=12).map("".join), max_size=12))
def test_parts_give_the_library_s_ids(texts):
    encoder = Encoder(TOKENIZER, most_parts=20)
    for _ in range(2):
        out = []
        for ids, n in encoder.encode(pa.array(texts, pa.string())):
            out += np.split(ids, np.cumsum(n)[:-1])
        assert [x.tolist() for x in out] == [ids_of(t) for t in texts]


def test_part_table_grows_and_finds():
    rng = np.random.default_rng(3)
    table, length = PartTable(), np.full(5000, 8)
    padded = rng.integers(1, 255, 5000 * 8 + 64, dtype=np.uint8)
    keys = part_keys(padded, np.arange(5000) * 8, length)
    for at in range(0, 4000, 500):
        table.insert(keys[:, at : at + 500], np.arange(at, at + 500))
    assert table.find(keys).tolist() == list(range(4000)) + [-1] * 1000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8b_round_trip(numbers):
    values = np.array(numbers, np.uint64)
    assert simple8b.unpack(*simple8b.pack(values), len(values)).tolist() == numbers


def test_simple8b_packs_densely_and_escapes():
    words, per_block, escapes, _ = simple8b.pack(np.full(256, 2**61, np.uint64))
    assert len(words) == len(escapes) == 256
    words, per_block, escapes, _ = simple8b.pack(np.zeros(256, np.uint64))
    assert len(words) == 3 and len(escapes) == 0 and per_block.tolist() == [3]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_the_library_s(spark, odd_docs, odd_rows, name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t))
    else:
        library = Tokenizer.from_file(path)
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    got = token_counts.token_counts(odd_docs, path, limit=100).collect()
    want = [(i, len((t or "").encode()), count(t or "")) for i, t, _ in odd_rows]
    assert sorted(map(repr, got)) == sorted(
        repr(type(got[0])(doc_id=i, n_bytes=b, n_tokens=n, over_limit=n > 100)) for i, b, n in want
    )


def test_counts_of_nothing(no_docs):
    df = token_counts.token_counts(no_docs, TOKENIZER)
    assert df.collect() == [] and df.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_frequent_parts_are_the_most_frequent(spark):
    docs = spark.createDataFrame([(k, "x the of the " + f"w{k}") for k in range(50)], "doc_id long, text string")
    assert token_counts.frequent_parts(docs, 2) == [b" the", b" of"]


def test_files_round_trip(spark, odd_docs, odd_rows):
    files = token_files.write_ids(odd_docs, TOKENIZER, end_id=0)
    got = token_files.read_back(files).orderBy("start").collect()
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    assert len(got) == len(order)
    for row, (doc_id, text, _) in zip(got, order, strict=True):
        ids = np.array([*ids_of(text), 0], "<u4")
        assert tuple(row) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    for row in files.collect():
        data = open(row.path.removeprefix("file:"), "rb").read()
        assert data.startswith(token_files.MAGIC) and data.endswith(token_files.MAGIC) and len(data) == row.n_bytes


def test_a_document_over_several_runs(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "_AT_ONCE", 2 * simple8b.BLOCK)
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 50_000, n, dtype=np.uint32) for n in (1, 2000, 512, 3, 1500)]
    path = str(tmp_path / "x.ids")
    writer = token_files.IdWriter(open(path, "wb"))
    for k, ids in enumerate(docs):
        writer.add(pa.array([k], pa.int64()), ids, np.array([len(ids)]))
    writer.close()
    rows = pa.RecordBatch.from_pylist([{"path": path, "start": 10}])
    got = [r for b in token_files._reader([rows]) for r in b.to_pylist()]
    assert [r["n_tokens"] for r in got] == [len(d) for d in docs]
    assert [r["ids_crc32"] for r in got] == [zlib.crc32(d.astype("<u4").tobytes()) for d in docs]
    assert got[0]["start"] == 10


def test_files_of_nothing(no_docs):
    assert token_files.read_back(token_files.write_ids(no_docs, TOKENIZER)).collect() == []


def test_packing_is_whole_and_gapless(odd_docs, odd_rows):
    rows = packing.pack_documents(odd_docs, TOKENIZER, capacity=64, end_id=2).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 64
    lengths = np.array([r.length for r in rows])
    assert len(bins) <= packing.lower_bound(lengths, 64) + 1
    whole = sorted(len(ids_of(t)) + 1 for _, t, _ in odd_rows)
    assert lengths.sum() == sum(whole)
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id), []).append(r)
    ids = [*ids_of(odd_rows[7][1]), 2]
    pieces = sorted(by_doc[7], key=lambda r: r.piece)
    assert [p.length for p in pieces[1:]] == [64] * (len(pieces) - 1)
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())


def test_groups_give_back_and_meet(spark):
    # halves and a bit: no two fit together, so the bound is the number of pieces; small ones fill the rest
    lengths = [520] * 60 + [500] * 60 + [4] * 60
    rows = [(k, 0, 0, n, k) for k, n in enumerate(lengths)]
    pieces = spark.createDataFrame(rows, packing._PIECES)
    packed = packing.pack(pieces, 1024, pieces_per_group=20).collect()
    assert len(packed) == len(rows)
    assert len({r.sequence_id for r in packed}) <= 62


def test_lower_bound():
    assert packing.lower_bound(np.array([600, 600, 600]), 1024) == 3
    assert packing.lower_bound(np.array([1024, 1]), 1024) == 2
    assert packing.lower_bound(np.array([342] * 4), 1024) == 2
    assert packing.lower_bound(np.zeros(0, np.int64), 1024) == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60))
def test_no_packing_beats_the_bound(lengths):
    lengths = sorted(lengths, reverse=True)
    bins, places = packing.best_fit(lengths, 100)
    used = {}
    for n, b, p in zip(lengths, bins, places, strict=True):
        assert used.get(b, 0) == p
        used[b] = p + n
    assert max(used.values()) <= 100
    assert packing.lower_bound(np.array(lengths), 100) <= len(used)


def test_packing_nothing(no_docs):
    df = packing.pack_documents(no_docs, TOKENIZER)
    assert df.collect() == []


def test_common_parts_survive_full_tables():
    rng = random.Random(9)
    common = [f" common{k}," for k in range(50)] + [" " + "long" * 12 + str(k) for k in range(5)]
    texts = []
    for k in range(400):
        words = [rng.choice(common) for _ in range(30)] + [f" rare{k}x{j}" for j in range(30)]
        rng.shuffle(words)
        texts.append("".join(words))
    small, library = Encoder(TOKENIZER, most_parts=2000), Encoder(TOKENIZER)
    asked = []
    whole = small.whole
    small.whole = lambda parts: asked.extend(parts) or whole(parts)
    for at in range(0, len(texts), 5):
        if at == 50:
            asked.clear()
        some = texts[at : at + 5]
        (ids, count), = small.encode(pa.array(some))
        assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == [x.tolist() for x in library.whole(some)]
    # common parts were asked for in the first batches only, though the tables were full again and again
    assert asked and not any("common" in part or "longlong" in part for part in asked)


def test_folders_of_the_caller_stay(spark, no_docs, tmp_path):
    system = spark._jvm.org.apache.hadoop.fs.Path(str(tmp_path)).getFileSystem(spark._jsc.hadoopConfiguration())
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    mine = tmp_path / "mine"
    mine.mkdir()
    (mine / "precious.txt").write_text("kept")
    token_files.write_ids(docs, TOKENIZER, folder=str(mine)).collect()
    own = token_files.write_ids(docs, TOKENIZER).first().path.rpartition("/")[0]
    marked = {str(p) for p in _marked(system)}
    assert any(p.endswith(own.rpartition("/")[2]) for p in marked) and not any(str(mine) in p for p in marked)


def _marked(system):
    """The paths that go when the application ends."""
    kind = system.getClass()
    while kind.getSimpleName() != "FileSystem":
        kind = kind.getSuperclass()
    field = kind.getDeclaredField("deleteOnExit")
    field.setAccessible(True)
    return [p.toString() for p in field.get(system).toArray()]
