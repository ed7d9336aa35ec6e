
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from rowkin.llm import pii, pseudo_likelihood
from rowkin.llm.decontaminate import chains, decontaminate
from rowkin.llm.quality import Bands, _limits, compression

LONG = "the old keeper of the northern lighthouse counted every passing ship each evening and wrote its colour into a heavy green book beside the kitchen window before going up to light the lamp again"


def near_copies(item):
    w = item.split()
    m = len(w) // 2
    return [" ".join(x) for x in (w, [*w[:m], "really", *w[m:]], w[:m] + w[m + 1 :], [*w[:m], "purple", *w[m + 1 :]])]


@pytest.mark.parametrize("n", [10, 15, 22, 30, 35])
def test_op2_finds_copies_with_one_word_changed_in_the_middle(spark, n):
    item = " ".join(LONG.split()[:n])
    texts = [f"nobody had asked {t} so nothing was said" for t in near_copies(item)]
    half = " ".join(LONG.split()[: n // 3])
    docs = spark.createDataFrame([*enumerate(texts), (9, f"{half} or so they say"), (10, "it was quite another thing to say")], "doc_id long, text string")
    got = {x.doc_id: x.contaminated for x in decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got == {0: True, 1: True, 2: True, 3: True, 9: False, 10: False}


def test_op2_chains_keep_copies_apart():
    first, second = [(i, i, []) for i in range(20)], [(i + 40, i, []) for i in range(20)]
    found = chains(first + second, 13)
    assert max(map(len, found)) == 20 and all(len({p - i for p, i, _ in c}) == 1 for c in found)


@pytest.mark.parametrize(("prose", "noise"), [(4096, 8104), (700, 1200)])
def test_op9_judges_tails_and_short_texts_by_chunks(prose, noise):
    r, packer, bands = random.Random(5), zstandard.ZstdCompressor(level=3), Bands()
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 7))) for _ in range(120)]
    calm = " ".join(r.choice(words) for _ in range(4000)).encode()
    signs = bytes(range(33, 123))
    text = calm[:prose] + bytes(r.choice(signs) for _ in range(noise))
    ratio, chunks, bad, kept = compression(text, packer, bands)
    assert ratio <= _limits(len(text), bands)[1]  # the whole alone would pass
    assert chunks >= 3 and bad > chunks / 2 and not kept
    assert compression(calm[: prose + noise], packer, bands)[2:] == (0, True)
    assert compression(calm[:prose] + text[prose : prose + 200], packer, bands)[3]  # a short noisy tail is tolerated


@pytest.mark.parametrize("shape", [pseudo_likelihood.Shape(), pseudo_likelihood.Shape(stride=5, rounds=3), pseudo_likelihood.Shape(stride=1, rounds=1)])
def test_op7_rounds_mask_every_word_once(shape):
    sizes = [4, 1, 0, 37]
    first, ids = np.concatenate([[0], np.cumsum(sizes)]), np.arange(sum(sizes)) % shape.size
    vocabulary = pseudo_likelihood.Vocabulary(np.zeros(0, np.uint64), np.zeros(shape.size), np.zeros(257), np.zeros(shape.buckets))
    model, packer = pseudo_likelihood.start_model(vocabulary, shape), zstandard.ZstdCompressor()
    batch = pa.record_batch([pa.array([pseudo_likelihood._squeeze(first, "<i8", packer)], pa.binary()), pa.array([pseudo_likelihood._squeeze(ids, "<u2", packer)], pa.binary())], names=["first", "ids"])
    places = 0
    for turn in range(shape.rounds):
        for out in pseudo_likelihood._train(iter([batch]), model, shape, turn):
            places += out.column(2)[0].as_py()
    assert places == sum(sizes)


@pytest.mark.parametrize(("told", "value", "kind"), [("password: ", "correcthorsebattery", "secret"), ("token=", "abcdefghijklmnop", "secret"), ("username ", "alice", "handle"), ("secret = ", "correct-horse-battery", "secret"), ("login: ", "marlowe", "handle")])
def test_op3_finds_secrets_and_handles_of_letters_alone(told, value, kind):
    field = pii.train()
    text = f"write it down, {told}{value} and go. " + f"they saw {value} again. " * 9
    _, every = pii.all_spans(text, field)
    assert {k for k, _, _ in every} == {kind} and len(every) == 10
    assert value not in pii.masked(text, every)
    for plain in ("the password is kept in the drawer", "the key point and the user manual", "the login page and a token of thanks"):
        assert pii.all_spans(plain, field) == ([], [])


def test_op2_finds_whole_items_without_windows(spark):
    items = {1: "12 15 18 21 24 27 30 33", 2: "Name three primes", 3: "今天天气怎么样呢", 4: "yes", 5: "Paris Rome London Madrid Lisbon"}
    texts = {1: "we had 12, 15, 18, 21, 24, 27, 30, 33 in a row", 2: "so: name THREE primes!", 3: "他问今天天气怎么样呢然后走了", 4: "Yes.", 5: "they saw Paris, Rome, London, Madrid, Lisbon",
             6: "yes it is", 7: "we had 12, 15, 18, 21, 24, 27, 30, 34 in a row", 8: "name two primes", 9: "今天天气怎么样", 10: "Rome Paris London Madrid Lisbon", 11: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x.doc_id: x.item_ids for x in decontaminate(docs, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    assert got == {i: str(i) if i <= 5 else "" for i in texts}
