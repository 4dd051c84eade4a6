"""Sequences filled with the tokens of their documents."""

import collections

import public_tokenizers
from tokenizers import Tokenizer

from screenloom.llm.packing import fill_sequences, pack_pieces, token_pieces


def test_repeated_and_null_ids_fill_their_own_places(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [(1, "one text"), (1, "another text of the same id"), (1, "one text"), (2, None), (None, "no id"), (None, "no id either"), (None, None), (3, "long " * 100), (4, "")]
    docs = spark.createDataFrame([(i, t, 7, "mine") for i, t in texts], "doc_id long, text string, offset int, bin string")
    pieces = token_pieces(docs, path, 32, 0, "doc_id", "text", keep_ids=True).cache()
    placed, _ = pack_pieces(pieces.drop("ids"), 32)
    filled = {r.sequence_id: r.ids for r in fill_sequences(pieces, placed).collect()}
    tokenizer = Tokenizer.from_file(path)
    want = collections.Counter()
    for i, t in texts:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want.update((i, len(ids), k, tuple(ids[k : k + 32])) for k in [0])
    got, total = collections.Counter(), 0
    for r in placed.collect():
        own = filled[r.sequence_id][r.offset : r.offset + r.length]
        assert len(own) == r.length
        total += r.length
        if r.piece == 0:
            got[r.doc_id, tuple(own)] += 1
    assert total == sum(map(len, filled.values())) == sum(n * c for (_, n, _, _), c in want.items())
    short = collections.Counter({(i, ids): c for (i, n, _, ids), c in want.items() if n <= 32})
    assert all(got[k] == c for k, c in short.items())
    assert fill_sequences(pieces.limit(0), placed.limit(0)).count() == 0
