"""The caches of words are bounded by bytes, whatever the words' number and length."""

from riskgraph.llm import packing


def test_cache_keeps_frequent_words_within_its_bytes():
    asked = []
    cache = packing._Cache(lambda w: asked.append(w) or w.encode(), 100_000)
    for i in range(5_000):
        assert cache[f"word{i}"] == f"word{i}".encode()
        assert cache["often"] == b"often"
        held = [*cache.items(), *cache.before.items()]
        assert sum(packing.ENTRY_BYTES + len(k) + len(v) for k, v in held) <= 102_000
    assert asked.count("often") == 1
