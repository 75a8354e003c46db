"""Tokens: encoding, packed files, best-fit packing."""

import bisect
import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lendwise.llm import best_fit, token_files
from lendwise.llm.common import fresh_path
from lendwise.llm.tokenization import WordEncoder, tokenizer_path
import edge

TOKENIZER = Tokenizer.from_file(tokenizer_path())


def ids_of(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB é́ÀßµªΣςİIı.'s,;!?-_0٣\t\n\x0b\x1c\x85\xa0​中文<|>ﬁǅ&"), max_size=40))
def test_words_encode_as_whole_texts(text):
    encoder = WordEncoder(tokenizer_path(), keep=5)
    for t in (text, f"{text} <|endoftext|>{text}", text.upper()):
        assert encoder.encode(t) == ids_of(t)[:-1].tobytes()


def test_bounded_memory_gives_the_same_ids(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    encoder = WordEncoder(tokenizer_path(), keep=300)
    assert all(encoder.encode(t) == ids_of(t)[:-1].tobytes() for t in texts)
    assert len(encoder.known) + len(encoder.known.old) < 20_000


def test_a_word_is_encoded_once_for_many_texts():
    encoder, merged = WordEncoder(tokenizer_path(), keep=1), []
    merge = encoder.merge
    encoder.merge = lambda p: merged.append(p) or merge(p)
    texts = ["Loan loan, \n déjà", None, "", " LOAN! x9 &&", "loan" * 30 + " loan."] * 200
    got = list(encoder.documents(pa.array(texts), 1))
    assert [d.tobytes() for d in got] == [ids_of(t).tobytes() for t in texts]
    assert len(merged) == 3 and {"loan", "loan" * 30} < set(merged)  # the third in the byte-level alphabet
    small = [d.tobytes() for d in encoder.documents(pa.array(["x", *texts])[1:], 1, span=20)]
    assert small == [d.tobytes() for d in got]


def test_word_memory_stays_small_over_new_words():
    encoder = WordEncoder(tokenizer_path())
    letters = "abcdefghijklmnop"
    words = ["".join(letters[n >> 4 * k & 15] for k in range(5)) + "." for n in range(400_000)]
    texts = [" ".join(words[a:a + 10_000]) for a in range(0, len(words), 10_000)]
    for t in texts:
        encoder.encode(t)
    held = [m for m in vars(encoder).values() if isinstance(m, dict)]
    assert sum(len(m) + len(m.old) for m in held) < 150_000


@pytest.mark.parametrize("bits", [1, 5, 8, 12, 16, 17, 24, 31, 32])
def test_packing_round_trip(bits):
    for n in (0, 1, 7, 1_000):
        ids = np.random.default_rng(n).integers(0, 1 << bits, n, dtype=np.uint64).astype("<u4")
        data = token_files.packed(ids, bits)
        assert len(data) == -(-n * bits // 8)
        assert (token_files.unpacked(data, bits, n) == ids).all()


def expected_files(rows):
    out, start = [], 0
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")):
        ids = ids_of(r.text)
        out.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 50_000, "block": 64, "vocabulary": 100_000}])
def test_files_round_trip(spark, sf, options):
    for df in (spark.read.parquet(f"{sf}/documents.parquet"), edge.table(spark), edge.empty(spark)):
        folder = fresh_path(spark, "tokens")
        token_files.write_token_files(df, folder, **options)
        got = token_files.read_token_files(spark, folder)
        assert sorted((tuple(r) for r in got.collect()), key=str) == expected_files(df.collect())


def test_random_access(spark, sf):
    folder = fresh_path(spark, "tokens")
    manifest = token_files.write_token_files(spark.read.parquet(f"{sf}/documents.parquet"), folder, block=100, vocabulary=1 << 17)
    store, path = token_files.file_system(folder)
    reader = token_files.ShardReader(store, f"{path}/{manifest[0]['name']}")
    whole = reader.ids(0, int(reader.starts[-1]))
    assert reader.bits == 17
    for a, b in [(0, 1), (99, 101), (100, 200), (250, 1_234), (len(whole) - 1, len(whole)), (5, 5)]:
        assert (reader.ids(a, b) == whole[a:b]).all()
    assert (reader.document(3) == whole[reader.starts[3]:reader.starts[4]]).all()


def naive(lengths, capacity):
    rooms, out = [], []
    for n in lengths:
        fits = [(r, k) for k, r in enumerate(rooms) if r >= n]
        if fits:
            r, k = min(fits)
        else:
            rooms.append(capacity)
            r, k = capacity, len(rooms) - 1
        out.append(capacity - r)
        rooms[k] -= n
    return len(rooms), sorted(rooms)


def places_of(lengths, capacity):
    """(sequence, offset) of pieces in falling length, by the plan on their counts."""
    runs = best_fit.best_fit_decreasing(dict(collections.Counter(lengths)), capacity)
    batch = pa.record_batch({"length": pa.array(lengths, pa.int64()), "rank": pa.array(range(1, len(lengths) + 1), pa.int64())})
    placed = next(best_fit.place(runs)(iter([batch])))
    return list(zip(placed.column("sequence_id").to_pylist(), placed.column("offset").to_pylist(), strict=True)), runs


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(50, 70))
def test_best_fit_decreasing(lengths, capacity):
    lengths = sorted(lengths, reverse=True)
    placed, _ = places_of(lengths, capacity)
    used = collections.Counter()
    by = collections.defaultdict(list)
    for (s, offset), n in zip(placed, lengths, strict=True):
        by[s].append((offset, n))
    for s, pieces in by.items():
        for offset, n in sorted(pieces):
            assert used[s] == offset
            used[s] += n
    assert naive(lengths, capacity) == (len(used), sorted(capacity - u for u in used.values()))


@pytest.mark.parametrize("kind", ["halves", "uniform", "short"])
def test_a_hundred_thousand_pieces_are_one_packing(kind):
    """As many sequences as one best-fit decreasing opens piece by piece; the plan does not grow with the pieces."""
    r = np.random.default_rng(3)
    n, capacity = 100_000, 4096
    lengths = {"halves": np.concatenate([r.integers(2200, 2500, n // 2), r.integers(1596, 1896, n // 2)]), "uniform": r.integers(1, capacity, n),
               "short": np.minimum(r.lognormal(5.5, 1.2, n).astype(int) + 1, capacity - 1)}[kind]
    lengths = np.sort(lengths)[::-1].tolist()
    placed, runs = places_of(lengths, capacity)
    rooms = [0] * (capacity + 1)  # open sequences by room
    opened, tight = 0, []
    for x in lengths:
        k = bisect.bisect_left(tight, x)
        if k == len(tight):
            opened, room = opened + 1, capacity
        else:
            room = tight[k]
            rooms[room] -= 1
            if not rooms[room]:
                tight.pop(k)
        left = room - x
        if left:
            if not rooms[left]:
                bisect.insort(tight, left)
            rooms[left] += 1
    assert len({s for s, _ in placed}) == opened
    assert len(runs) < 40_000
    more, _ = best_fit.best_fit_decreasing({x: 1_000 * c for x, c in collections.Counter(lengths).items()}, capacity), None
    assert len(more) < 60_000  # a hundred million pieces


def check_packing(df, capacity, **options):
    got = best_fit.pack(df, capacity=capacity, keep_ids=True, **options).collect()
    want = collections.Counter()
    for r in df.collect():
        ids = ids_of(r.text)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want[(r.doc_id, piece, at, len(part), zlib.crc32(part.tobytes()), part.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == want
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        end = 0
        for offset, length in sorted(p):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places), sum(r.length for r in got) / capacity


def test_packing_is_tight(spark, sf):
    used, least = check_packing(spark.read.parquet(f"{sf}/documents.parquet"), 4096)
    assert used <= least + 2


def test_packing_hard_rows(spark):
    check_packing(edge.table(spark), 64)
    first = check_packing(edge.table(spark), 64)
    assert check_packing(edge.table(spark).repartition(5), 64) == first  # whatever the partitioning
    assert best_fit.pack(edge.empty(spark)).count() == 0


def test_equal_long_pieces_get_sequences_of_their_own(spark):
    random.seed(1)
    df = spark.createDataFrame([(1, "a " * 500)] * 6 + [(2, "b " * 64)], "doc_id long, text string").repartition(3)
    check_packing(df, 32)


def test_the_collector_rests_while_words_are_learned():
    import gc

    encoder, runs = WordEncoder(tokenizer_path()), []
    count = lambda phase, info: runs.append(phase)
    text = " ".join(f"{a}{b}{c}{d}" for a in "abcdefghij" for b in "klmnopqrst" for c in "aeiouy" for d in ("u", "v,", "é.", "w9"))
    gc.collect()
    gc.callbacks.append(count)
    try:
        found = encoder.encode(text)
    finally:
        gc.callbacks.remove(count)
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert not runs and gc.isenabled() and np.frombuffer(found, "<u4").tolist() == whole
    gc.disable()
    try:
        encoder.encode("one more")
        assert not gc.isenabled()
    finally:
        gc.enable()
