"""Every decision of line dedup takes effect, on the text it was made for."""

from rollcall.llm import line_dedup

SHARED = ["all rights are reserved by the owner of these many pages", "subscribe to our weekly letter and never miss another story"]


def test_boilerplate_and_self_repeating_pages_lose_their_lines(spark):
    again = "one and the same line, over and over on a page of its own"
    texts = {1: "\n".join(SHARED), 2: "\n".join([*SHARED, "its own words"]), 3: "\n".join([again] * 100), 4: "\n".join(SHARED)}
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in texts.items()], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in line_dedup.drop_lines(docs).collect()}
    assert got == {1: (texts[1], len(texts[1])), 2: ("its own words", 13), 3: (again, len(again)), 4: ("", 0)}


def test_texts_under_one_id_are_documents_of_their_own(spark):
    lines = [f"{word} is what this line is about and no other line says so" for word in ("astronomy", "bricklaying", "cookery", "dentistry", "economics")]
    a, b, c, d, e = lines
    texts = [(1, a), (None, f"{a}\n{b}"), (None, f"{c}\n{d}"), (5, e), (5, f"{d}\n{c}"), (5, f"{d}\n{c}")]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in texts], "doc_id long, text string, n_chars long")
    got = sorted((r["doc_id"] or 0, r["text"]) for r in line_dedup.drop_lines(docs).collect())
    assert got == sorted([(1, a), (0, b), (0, ""), (5, e), (5, f"{d}\n{c}"), (5, f"{d}\n{c}")])
    counts = {r["doc_id"]: (r["n_lines"], r["n_exact"]) for r in line_dedup.report(docs).collect()}
    assert counts == {1: (1, 0), 5: (3, 0), None: (4, 3)}
