import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rowkin.llm.packing import best_fit, plan
from rowkin.llm.token_ids import encoded, tokenizer_path
from rowkin.llm.training_order import Layout, permute, read_from, tidy, write_training_order


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_table_gives_the_tokenizers_ids(tokenizer):
    r = random.Random(1)
    odd = ["don't I'M we'Re", "<|endoftext|> x<|startoftext|>.", "é ́x", "İstanbul ΑΣ Σ", "ＡＢ 12３ ½", "a ̧́ b", "H̱i ẖi", "\r\nx\ry", None, "", "..., a. b, c.d,"]
    signs = " \n\t ́aB1'st<|endoftext|>., é😀\x1c"
    odd += ["".join(r.choice(signs) for _ in range(r.randint(1, 30))) for _ in range(3000)]
    got = [ids[a:b].tolist() for _, ids, first in encoded(iter([pa.RecordBatch.from_arrays([pa.array(odd)], names=["t"])]), tokenizer_path(), 0) for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got == [ids_of(tokenizer, x) for x in odd]


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 50, 2048])
    histogram = {n: r.randint(1, 40) for n in r.sample(range(1, capacity + 1), r.randint(1, min(capacity, 40)))}
    rows, sequences = plan(histogram, capacity)
    bins = {}
    for length, count in histogram.items():
        own = sorted((x for x in rows if x[0] == length), key=lambda x: x[1])
        for rank in range(count):
            x = [y for y in own if y[1] <= rank][-1]
            k = rank - x[1]
            bins.setdefault(x[2] + k // x[3], []).append((x[4] + k % x[3] * length, length))
    assert set(bins) == set(range(sequences))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    free = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [x for x in free if x >= length]
            room = min(fits) if fits else capacity
            if fits:
                free.remove(room)
            free.append(room - length)
    assert len(free) == sequences


def test_packing_places_every_piece_once(spark, odd_docs, tokenizer):
    rows = best_fit(odd_docs, capacity=64).collect()
    texts = [(x.doc_id, x.text) for x in odd_docs.collect()]
    want = []
    for i, text in texts:
        ids = [*ids_of(tokenizer, text), 0]
        want += [(i, k // 64, k, len(ids[k : k + 64]), zlib.crc32(np.array(ids[k : k + 64], "<u4").tobytes())) for k in range(0, len(ids), 64)]
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in rows), key=key) == sorted(want, key=key)
    by = {}
    for x in rows:
        by.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert best_fit(odd_docs.limit(0)).count() == 0


def test_permutation_is_a_bijection():
    for n in (1, 2, 3, 16, 17, 1000, 4097):
        slots = permute(np.arange(n), n, 7)
        assert sorted(slots.tolist()) == list(range(n))
        assert (permute(slots, n, 7, inverse=True) == np.arange(n)).all()
    assert (permute(np.arange(1000), 1000, 7) != permute(np.arange(1000), 1000, 8)).any()


def test_shards_round_trip_and_resume(spark, odd_docs, tokenizer, tmp_path):
    layout = Layout(stride=16, slots_per_shard=50)
    folder = f"file://{tmp_path}/shards"
    rows = sorted(write_training_order(odd_docs, folder, layout).collect())
    records = list(read_from(folder, 0, layout))
    assert [x.slot for x in rows] == list(range(len(records)))
    got = sorted(tuple(record[: x.n_tokens].tolist()) for x, record in zip(rows, records, strict=True))
    want = sorted(tuple(ids[k : k + 16]) for ids in (ids_of(tokenizer, x.text) for x in odd_docs.collect()) for k in range(0, len(ids), 16))
    assert got == want
    assert all((record[x.n_tokens :] == layout.fill).all() and zlib.crc32(record.tobytes()) == x.record_crc32 for x, record in zip(rows, records, strict=True))
    assert [x.tolist() for x in read_from(folder, 137, layout)] == [x.tolist() for x in records[137:]]
    assert {x.path for x in rows} == {f"{folder}/shard-{k:08d}.bin" for k in range(-(-len(records) // 50))}
    (tmp_path / "shards" / ".shard-00000000.bin.lost").write_bytes(b"x")
    assert tidy(folder) == 1 and tidy(folder) == 0 and tidy(f"{folder}-none") == 0
    assert write_training_order(odd_docs.limit(0), f"{folder}-none", layout).count() == 0
    with pytest.raises(ValueError, match="ids reach"):
        write_training_order(odd_docs, folder, Layout(fill=40_000))
    with pytest.raises(Exception, match="nowhere"):
        write_training_order(odd_docs, "nowhere://x/y", layout)


def test_other_tokenizer_files_are_encoded_whole(spark, odd_docs, tmp_path):
    path = tokenizer_path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    texts = ["Hello  World\n\n x", "don't STOP", None, "", "日本 a.b,c ", "word " * 300]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    got = [ids[a:b].tolist() for _, ids, first in encoded(iter([batch]), path, 0) for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got == [ids_of(own, x) for x in texts]
    layout = Layout(stride=16, slots_per_shard=50, fill=(1 << 32) - 1, dtype="<u4")
    rows = write_training_order(odd_docs, f"file://{tmp_path}/wide", layout, path).collect()
    records = list(read_from(f"file://{tmp_path}/wide", 0, layout))
    want = sorted(tuple(ids[k : k + 16]) for ids in (ids_of(own, x.text) for x in odd_docs.collect()) for k in range(0, len(ids), 16))
    assert sorted(tuple(records[x.slot][: x.n_tokens].tolist()) for x in rows) == want
