"""Texts of a batch pass through the tokenizer's table a part at a time."""

from bazaarlake.llm import pieces, queries


def test_chunks_are_held_a_part_at_a_time(monkeypatch):
    monkeypatch.setattr(pieces, "PART_CHARS", 40)
    with open(queries.tokenizer_path(), "rb") as file:
        table = pieces.ChunkTable(file.read())
    learnt = []
    learn = table.learn
    monkeypatch.setattr(table, "learn", lambda chunks: (learnt.append(len(chunks)), learn(chunks)))
    texts = ["one two three", None, "", "four five", "a b c d e f g h i j k l m n o p q r s t u"] * 3
    for text, chunks in zip(texts, table.encode_in_parts(texts), strict=True):
        ids = [i for c in chunks for i in table.ids[c]]
        assert ids == (table.model.encode(text) if text else [])
    assert len(learnt) > 3 and max(learnt) <= 21
