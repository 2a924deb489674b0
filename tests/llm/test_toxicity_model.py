"""The toxicity model by itself: windows, dictionaries, samples of long texts."""

import random

import numpy as np
import zstandard

from clickloom.llm import toxicity

SYLLABLES = [a + b for a in ("b", "d", "f", "g", "gu", "k", "l", "m", "n", "qu", "r", "st", "t", "w") for b in "aeiou"]


def prose(rng, n, extra=()):
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    for w in extra:
        words[rng.randrange(n)] = w
    return " ".join(words).encode()


def samples(seed=1, n=200):
    """Toxic texts repeat words with a stem that ordinary ones hold once, now and then, by chance."""
    rng = random.Random(seed)
    toxic = [prose(rng, 80, ["faguonoqua" + rng.choice(SYLLABLES) for _ in range(4)]) for _ in range(n)]
    plain = [prose(rng, 80, ["faguonoquari"] * (rng.random() < 0.03)) for _ in range(2 * n)]
    return toxic, plain


def test_windows_cover_every_byte():
    for lengths in ([0, 1, 63, 64, 65, 116, 117, 1000], [0], [5]):
        starts, ends, owner = toxicity.windows(np.array(lengths))
        base = np.concatenate([[0], np.cumsum(lengths)])
        for k, n in enumerate(lengths):
            mine = [(a - base[k], b - base[k]) for a, b, o in zip(starts, ends, owner, strict=True) if o == k]
            assert {i for a, b in mine for i in range(a, b)} == set(range(n))
            assert all(b - a <= toxicity.WINDOW for a, b in mine)


def test_advantage_is_the_difference_of_compressed_lengths():
    toxic, ordinary = b"x " * 300 + b" wretched ", b"x " * 300 + bytes(10)
    scales = toxicity._Scales(toxic, ordinary)
    text = b"they are wretched folk, truly wretched, and the rest of it is plain"
    gain, owner = toxicity.advantages([text, b""], scales)
    plain = zstandard.ZstdCompressionParameters.from_level(
        toxicity.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
    )

    def size(piece, content):
        made = zstandard.ZstdCompressionDict(content + toxicity._TAIL, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(dict_data=made, compression_params=plain).compress(piece))

    cuts = [text[a : a + toxicity.WINDOW] for a in (0, toxicity.STEP)]
    assert gain.tolist() == [size(c, ordinary) - size(c, toxic) for c in cuts] and set(owner) == {0}
    assert gain[0] > 0  # the last passage of a dictionary is found as well


def test_repeated_stems_tell_what_chance_does_not():
    model = toxicity.fit(*samples(n=800))
    assert b" faguonoqua" in model.toxic and len(model.toxic) == len(model.ordinary)
    toxic, plain = samples(seed=2)
    assert np.mean(model.scores(toxic) >= 0.3) >= 0.95
    assert np.mean(model.scores(plain) >= 0.3) <= 0.05
    assert model.scores([b""])[0] < 0.3


def test_passages_grow_while_occurrences_agree():
    grown = toxicity._agreed(b" abcdef", toxicity.Counter({b"gh one": 7, b"gh two": 2, b"xy": 1}))
    assert grown == b"gh "  # to the end of the word
    assert toxicity._agreed(b" abcdef", toxicity.Counter({b"g": 1, b"h": 1})) == b""


def test_long_texts_teach_by_evenly_spaced_parts(spark):
    long = b"".join(b"%07d " % k for k in range(100_000))
    taken = toxicity.sampled(long)
    assert len(taken) <= toxicity.SAMPLE_BYTES + toxicity.SAMPLE_BYTES // toxicity.PART
    assert taken.startswith(long[: toxicity.PART]) and taken.endswith(long[-toxicity.PART :])
    assert toxicity.sampled(b"short") == b"short"
    docs = spark.createDataFrame([(1, "Z" * 70_000 + "É"), (3, None), (4, "")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (3, 1), (4, 0)], "doc_id bigint, toxic int")
    rows = toxicity.training_sample(docs, labels, 1, 9, 10).collect()
    assert [(r["y"], bytes(r["text"])[:2], bytes(r["text"])[-2:]) for r in rows] == [(1, b"zz", "é".encode())]
