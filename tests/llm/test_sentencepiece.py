import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexispark.llm.sentencepiece import MODEL, Encoder, Vocabulary, decode, decode_bytes, encode, viterbi

V = Vocabulary.load(MODEL)
PIECES = {i: p for p, i in V.pieces.items()}


def cost(ids):
    return sum(V.prefixes[PIECES[i]][1] if i in PIECES else 20_000 for i in ids)


def cheapest(text):
    best = [0] + [10**12] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + V.longest) + 1):
            if text[i:j] in V.pieces:
                best[j] = min(best[j], best[i] + V.prefixes[text[i:j]][1])
        if text[i] not in V.pieces:
            best[i + 1] = min(best[i + 1], best[i] + 20_000 * len(text[i].encode()))
    return best[-1]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeinrst  \n.▁éß你🙂"), max_size=200))
def test_round_trip_and_cost(text):
    ids = np.frombuffer(Encoder(V).encode(text), np.int32).tolist()
    assert decode_bytes(ids, V) == text.encode()
    if text:
        assert cost(ids) == cheapest(" " + text) == cost(viterbi(" " + text, V))
        assert ids == viterbi(" " + text, V)


def test_long_stretch_is_committed_in_parts():
    text = "abcdefghij" * 3000
    assert cost(viterbi(text, V)) == cheapest(text)


def test_ids_are_committed_as_paths_meet():
    """No more ids are held back than a few windows hold, at any length."""
    text, out, lags = "abcdefghij" * 500, [], []

    class Watched(str):
        def __getitem__(self, at):
            if isinstance(at, slice) and at.stop == at.start + 1:
                lags.append(at.start - sum(len(PIECES[i]) for i in out))
            return str.__getitem__(self, at)

    viterbi(Watched(text), V, out.extend)
    assert out == viterbi(text, V) and len(lags) >= len(text) and max(lags) <= 4 * V.longest
    assert viterbi("", V) == []


def test_frame(spark, docs):
    rows = [(1, "Hello  world\n▁"), (2, None), (3, ""), (3, ""), (4, "x" * 70_000)]
    frame = docs(rows).withColumnRenamed("lang", "ids")
    coded = encode(frame, check_col="same")
    out = {x.doc_id: x for x in coded.collect()}
    assert coded.count() == 5 and out[2].ids is None and out[3].ids == [] and all(x.same for x in out.values())
    back = {x.doc_id: x.text for x in decode(coded).collect()}
    assert back == dict(rows)
    assert encode(docs([])).count() == 0


def test_against_library():
    """The same model as a unigram one in the library, with our costs as scores."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    m = proto.ModelProto()
    with open(MODEL, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for i, p in enumerate(m.pieces):
        if i in PIECES:
            p.score = -V.prefixes[PIECES[i]][1] / 1000
    sp = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    for text in ("the quick brown fox", "Être ou ne pas être", "token = secret"):
        assert abs(cost(sp.encode(text)) - cost(np.frombuffer(Encoder(V).encode(text), np.int32).tolist())) <= 1
