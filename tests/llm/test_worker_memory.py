import tracemalloc

import public_tokenizers
import pyarrow as pa
from llm.helpers import prose
from tokenizers import Tokenizer
from xxhash import xxh3_128_digest

from postlode.llm import shared, tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_chunks_seen_take_few_bytes():
    encoder = tokens.ChunkEncoder(BYTES, True)
    list(encoder.encode(pa.array(["once more"])))  # the first call imports pandas
    tracemalloc.start()
    try:
        for low in range(0, 100_000, 10_000):
            list(encoder.encode(pa.array([" ".join(f"w{i * 7919}" for i in range(low, low + 10_000))])))
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 9_000_000  # a dictionary of the chunks takes over 16 MB


def test_chunks_that_share_half_a_digest_are_told_apart(monkeypatch):
    monkeypatch.setattr(tokens, "xxh3_128_digest", lambda x: bytes([len(x) % 2] * 8) + xxh3_128_digest(x)[8:])
    for name, value in (("MEMORY", 40), ("KEPT", 15)):
        monkeypatch.setattr(tokens, name, value)
    encoder, library = tokens.ChunkEncoder(BYTES, True), Tokenizer.from_file(BYTES)
    for i in range(12):
        text = prose(i % 5, 50)
        (found, _), = encoder.encode(pa.array([text]))
        assert found.tolist() == library.encode(text, add_special_tokens=False).ids


def test_frequent_chunks_are_kept(monkeypatch):
    for name, value in (("MEMORY", 30), ("KEPT", 10)):
        monkeypatch.setattr(tokens, name, value)
    encoder, learnt = tokens.ChunkEncoder(BYTES, True), []
    plain = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda chunks: learnt.extend(chunks) or plain(chunks))
    for i in range(20):
        rare = " ".join(f"rare{i}x{j}" for j in range(20))
        list(encoder.encode(pa.array([f"{rare} often often often"])))
    assert learnt.count(" often") == 1  # it was met after the chunks of the first text


def test_what_other_operators_cached_goes_before_a_task():
    cache = shared.worker_cache()
    cache.update({("encoder", "path"): 1, ("pair", "path"): 2, "golay": 3})

    def run(iterator):
        yield from ({k if isinstance(k, str) else k[0] for k in cache if not str(k).startswith("__")} for _ in iterator)

    try:
        assert list(shared.lean(run, "encoder", "golay")([1, 1])) == [{"encoder", "golay"}] * 2
        assert list(shared.lean(run)([1])) == [set()]
    finally:
        for key in (("encoder", "path"), ("pair", "path"), "golay"):
            cache.pop(key, None)
