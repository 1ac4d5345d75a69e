import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tablelift.llm import bpe, packing, pieces, token_counts
from tablelift.llm.words import spans
from tests.llm.conftest import odd_rows


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary)


@pytest.fixture(scope="module")
def wanted(library):
    return sorted(((i, tuple(library.encode(t or "", add_special_tokens=False).ids), len((t or "").encode())) for i, t, *_ in odd_rows()), key=repr)


def test_counts(odd, none, vocabulary, wanted):
    rows = token_counts.token_counts(odd, vocabulary, limit=100).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows), key=repr) == sorted(((i, b, len(x), len(x) > 100) for i, x, b in wanted), key=repr)
    assert token_counts.token_counts(none, vocabulary).collect() == []


def test_encode_and_decode(odd, none, vocabulary, library, wanted):
    encoded = bpe.encode(odd, vocabulary)
    rows = encoded.collect()
    assert sorted(((r.doc_id, tuple(r.ids)) for r in rows), key=repr) == sorted(((i, x) for i, x, _ in wanted), key=repr)
    back = {(r.doc_id, r.text) for r in bpe.decode(encoded, vocabulary).collect()}
    assert back == {(i, library.decode(list(x), skip_special_tokens=False)) for i, x, _ in wanted}
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(odd, vocabulary).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert digests == {(i, len(x), sha(" ".join(map(str, x))), sha(library.decode(list(x), skip_special_tokens=False))) for i, x, _ in wanted}
    assert bpe.encode(none, vocabulary).collect() == [] and bpe.digests(none, vocabulary).collect() == []


def test_cuts_are_certain(vocabulary, library):
    """Random strings of byte pairs that are rare in the vocabulary, where cuts are many."""
    encoder, r = bpe.ForcedBoundaryEncoder(vocabulary), random.Random(5)
    letters = "abcxyzqjkv'éßñçøαжд中🙂́,.!#0123"
    cut = 0
    for _ in range(3000):
        word = "".join(r.choice(letters) for _ in range(r.randint(1, 14)))
        assert encoder.word(word) == library.encode(word, add_special_tokens=False).ids, word
        for piece, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(word)):
            fragments = encoder.cuts(piece)
            assert "".join(fragments) == piece
            cut += len(fragments) > 1
    assert cut > 1000


def test_remembered_words_may_be_forgotten(vocabulary, library):
    """Generations of a few words: whatever is forgotten is encoded again, whatever is used stays."""
    r = random.Random(3)
    names = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 9))) for _ in range(4000)]
    words = pieces.WordIds(pieces.library_ids(vocabulary), pieces.ids_below(vocabulary), generation_bytes=150_000)
    for k in range(60):
        text = " ".join(["always", "here", *r.choices(names[: 100 + 60 * k], k=200)]).encode()
        data = np.frombuffer(text, np.uint8)
        start, end, _ = spans(data, np.array([0, len(data)]))
        ids, lengths = words.ids(words.rows(data, start, end))
        assert ids.dtype == np.uint32 and lengths.sum() == len(ids)
        assert ids.tolist() == library.encode(text.decode(), add_special_tokens=False).ids
    assert words.kind is np.uint16 and words.old.count and words.encoded > len(set(names)) * 0.5
    again = words.encoded
    data = np.frombuffer(b"always here", np.uint8)
    words.rows(data, *spans(data, np.array([0, 11]))[:2])
    assert words.encoded == again


def test_wide_ids_keep_their_bits():
    words = pieces.WordIds(lambda new: [[70_000 + len(w), 5] for w in new], 80_000)
    data = np.frombuffer(b"a bbb", np.uint8)
    assert words.ids(words.rows(data, *spans(data, np.array([0, 5]))[:2]))[0].tolist() == [70_001, 5, 70_003, 5]


def test_vocabularies_with_a_decoder_are_refused(vocabulary, tmp_path):
    import json

    spec = json.loads(open(vocabulary, encoding="utf-8").read())
    spec["decoder"] = {"type": "BPEDecoder", "suffix": "</w>"}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError, match="decoder of its own"):
        bpe.ForcedBoundaryEncoder(str(path))


def test_tokenizers_that_keep_white_space_are_refused():
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    with pytest.raises(ValueError, match="white space"):
        pieces.load(path)


@pytest.mark.parametrize("size", [16, 2048])
def test_packing_covers_every_id_once(odd, none, vocabulary, wanted, size):
    rows = packing.pack(odd, vocabulary, size=size, with_ids=True).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append(r)
    assert sorted(sequences) == list(range(len(sequences)))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= size
    ids_of = defaultdict(list)
    for i, x, _ in wanted:
        ids_of[i].append([*x, 1])
    for i, own in documents.items():
        copies = len(ids_of[i])
        starts = sorted(own, key=lambda r: r.start)
        for k in range(copies):
            row = [t for r in starts[k::copies] for t in r.ids]
            assert row == ids_of[i][k]
            assert all(r.doc_tokens == len(row) and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in starts[k::copies])
    assert documents.keys() == ids_of.keys()
    assert packing.pack(none, vocabulary).collect() == []


def _one_by_one(histogram, size):
    """Sequences that shortest-pack-first needs when every piece is placed by itself."""
    rooms, count = [], 0
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            if rooms and -rooms[0] >= length:
                heapq.heapreplace(rooms, rooms[0] + length)
            else:
                heapq.heappush(rooms, length - size)
                count += 1
    return count


def test_plan_places_all_lengths_like_single_pieces():
    r = random.Random(1)
    for size, most in ((1, 10_000), (7, 10_000), (64, 5000), (300, 300), (2048, 60)):
        histogram = {n: r.randint(1, most) for n in range(1, size + 1) if r.random() < 0.7} or {1: 5}
        patterns = packing.plan(histogram, size)
        placed = defaultdict(int)
        for count, pattern in patterns:
            assert count > 0 and sum(a * b for a, b in pattern) <= size
            for length, times in pattern:
                placed[length] += count * times
        assert placed == histogram
        assert len(patterns) <= 4 * size
        used, sequences = sum(k * v for k, v in histogram.items()), sum(c for c, _ in patterns)
        # No way of packing needs fewer than the tokens fill, or than there are pieces longer than half a sequence.
        least = max(-(-used // size), sum(v for k, v in histogram.items() if 2 * k > size))
        assert least <= sequences <= _one_by_one(histogram, size) + len(histogram)
    assert packing.plan({100: 10_000}, 2048) == [(500, [(100, 20)])]
