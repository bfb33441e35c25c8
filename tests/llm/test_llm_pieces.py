import random
import struct

import pytest
from llm_cases import SF, clashing, messy, rows

from logloom.llm import pieces, registry

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def model():
    with open(pieces.MODEL, "rb") as file:
        return pieces.Pieces.read(file.read())


@pytest.fixture(scope="module")
def oracle():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def ids_of(text, model, known):
    words = pieces.marked_words(text)
    found = dict(pieces.encode_words(set(words), model, None, known))
    return [i for word in words for i in found[word]]


def test_query_equals_the_models_own_encoder(spark, oracle):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = registry.QUERIES["op3_sentencepiece"](spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r.token_ids == oracle.encode(texts[r.doc_id])
        assert r.round_trip and r.n_tokens == len(r.token_ids)


def test_random_texts(model, oracle):
    draw, known = random.Random(5), {}
    letters = list(" ▁\n\tabcthe.,0123你好üñ😀é-") + [" "] * 6 + list("etaoinshr") * 2
    root, table = pieces.trie(model), pieces.byte_table(model)
    for _ in range(1500):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 40)))
        words = pieces.marked_words(text)
        found = dict(pieces.encode_words(set(words), model, root, known))
        ids = [i for word in words for i in found[word]]
        assert ids == oracle.encode(text), text
        assert pieces.decode(ids, table) == oracle.decode(ids) == text.replace("▁", " "), text


def test_order_and_sharing_do_not_matter(model):
    words = [pieces.MARK + w for w in "internationalisation international internals inter interest in i".split()]
    together = dict(pieces.encode_words(words, model))
    assert together == {w: next(pieces.encode_words([w], model))[1] for w in words}


def unigram_model(scores):
    def varint(n):
        out = b""
        while True:
            n, low = n >> 7, n & 127
            out += bytes([low | (128 if n else 0)])
            if not n:
                return out

    def sized(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    def piece(name, score, kind):
        return sized(1, sized(1, name.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score) + varint(3 << 3) + varint(kind))

    out = piece("<unk>", 0.0, 2) + b"".join(piece(f"<0x{b:02X}>", 0.0, 6) for b in range(256))
    out += b"".join(piece(name, score, 1) for name, score in scores.items())
    return out + sized(2, varint(3 << 3) + varint(1) + varint(35 << 3) + varint(1)) + sized(3, sized(1, b"identity") + varint(4 << 3) + varint(0))


def test_unigram_models_take_the_best_path():
    scores = {"▁": -4.0, "a": -3.0, "b": -3.0, "ab": -3.5, "ba": -3.2, "▁a": -5.0, "aba": -9.0, "▁ab": -6.0}
    model = pieces.Pieces.read(unigram_model(scores))

    def best(word):
        if not word:
            return 0.0, []
        options = [(best(word[n:]), word[:n]) for n in range(1, len(word) + 1) if word[:n] in scores]
        return max((score + scores[head], [head, *rest]) for (score, rest), head in options)

    for word in ("▁abab", "▁ba", "abba", "▁aab", "bababab"):
        found = [model.names[i] for i in next(pieces.encode_words([word], model))[1]]
        assert sum(scores[p] for p in found) == pytest.approx(best(word)[0]) and "".join(found) == word


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        pieces.Pieces.read(b"")


def test_messy_rows(spark, oracle):
    docs = clashing(messy(spark), "n_tokens", "token_ids", "round_trip")
    found = rows(pieces.encode(docs))
    expected = []
    for r in messy(spark).collect():
        ids = oracle.encode(r.text or "")
        expected.append((r.doc_id, len(ids), ids, "▁" not in (r.text or "")))
    assert found == sorted(expected, key=repr)
    assert pieces.encode(messy(spark, [])).count() == 0
