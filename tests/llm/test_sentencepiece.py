import random

import pyarrow as pa
import pytest

from tidemark.llm import sentencepiece as sp

PATH = "/opt/tokenizers/piece_bpe_32k.model"


def brute(model, text):
    """The best path by plain dynamic programming over the whole text."""
    text = text.replace(sp.MARK, " ")
    text = " " + text if text else text
    by = {s.decode(): i for s, i in model.pieces}
    n = len(text)
    best = [(0.0, [])] + [None] * n
    for a in range(n):
        one = False
        for b in range(a + 1, min(n, a + 30) + 1):
            if (i := by.get(text[a:b])) is not None:
                one |= b == a + 1
                new = best[a][0] + model.scores[i]
                if best[b] is None or new > best[b][0]:
                    best[b] = (new, best[a][1] + [i])
        if not one:
            new = best[a][0] + model.unknown_score
            if best[a + 1] is None or new > best[a + 1][0]:
                best[a + 1] = (new, best[a][1] + [int(model.byte_ids[x]) for x in text[a].encode()])
    return best[n][1]


def samples():
    r = random.Random(4)
    out = ["", " ", "  a  b", "\n\n", "日本語 😀😀", "a▁b", "\t tab", "x" * 100, "...    ...", "the that and", "\x00\x7f"]
    out += ["".join(r.choice("abehnrst  \n.,é日") for _ in range(r.randint(1, 80))) for _ in range(200)]
    return out


@pytest.fixture(scope="module")
def model():
    return sp.Model.load(PATH)


def test_encoding_against_plain_viterbi_and_round_trip(model):
    texts = [*samples(), None]
    ids = sp.encode_column(model, pa.array(texts))
    assert ids.to_pylist() == [None if t is None else brute(model, t) for t in texts]
    assert sp.decode_column(model, ids).to_pylist() == [None if t is None else t.replace(sp.MARK, " ") for t in texts]


def test_encoding_against_the_library_lattice(model):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    words = ["the", "then others", "whst the by", "Is ndble whst", "onanhe of ing", "Enüst einverge", "ciónes que"]
    own = sp.encode_column(model, pa.array(words)).to_pylist()
    assert own == [library.nbest_encode_as_ids(w, 2)[0] for w in words]  # of one path alone the library takes a shortcut
    assert [library.decode(x) for x in own] == words


def test_small_vocabularies():
    kinds = [("<unk>", 0.0, sp.UNKNOWN), ("▁", -3.0, 1), ("a", -1.0, 1), ("ab", -1.5, 1), ("b▁a", -0.1, 1), ("b", -1.0, 1)]
    m = sp.Model.of(kinds)
    assert m.crossing
    assert sp.encode_column(m, pa.array(["ab a", "zzzq a", "ab"])).to_pylist() == [[1, 2, 4], [1, 0, 1, 2], [1, 3]]


def test_invalid_bytes_are_replaced(model):
    ids = [[int(model.byte_ids[0xFF]), int(model.byte_ids[0x41])], [], None]
    assert sp.decode_column(model, pa.array(ids, pa.list_(pa.int32()))).to_pylist() == ["�A", "", None]


def test_frames(spark):
    df = spark.createDataFrame([(1, "the cat", 7), (2, None, 8), (None, "", None)], "doc_id long, text string, ids int")
    got = sp.decode(sp.encode(df, PATH), PATH).orderBy("doc_id").collect()
    assert [r.decoded for r in got] == ["", "the cat", None]
    assert sp.encode(df.filter("doc_id = 9"), PATH).collect() == []
    assert sp.encode(df.withColumnRenamed("ids", "IDS"), PATH).columns == ["doc_id", "text", "ids"]
    both = sp.encode(df, PATH, decoded_col="decoded")
    assert both.columns == ["doc_id", "text", "ids", "decoded"] and sorted(map(str, both.collect())) == sorted(map(str, sp.decode(sp.encode(df, PATH), PATH).collect()))
