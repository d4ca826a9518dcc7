"""Words are drawn once where they were several times; the results stay."""

from rollcall.llm import fingerprint

TEXTS = ["", " \n", "one two two three", "一 丁 two", "", "x" * 70_000 + " end", *[" ".join(f"w{i * j % 997}" for j in range(i)) for i in range(0, 900, 37)], ""]


def test_signatures_together_are_those_of_each_text():
    for cached in (1, 50, 2**16):
        sampler = fingerprint.Sampler(cached=cached)
        wanted = [fingerprint.Sampler().signature(t).tolist() for t in TEXTS]
        assert [s.tolist() for s in sampler.signatures(TEXTS)] == wanted
        assert [s.tolist() for s in sampler.signatures(TEXTS)] == wanted
    assert not fingerprint.Sampler().signatures(["", " "])[0].any()


def test_edited_texts_draw_no_word_again(spark, monkeypatch):
    words = [f"w{i}" for i in range(400)]
    rows = spark.createDataFrame([(False, i, " ".join(words[i * 100 : i * 100 + 100])) for i in range(4)], "guest boolean, doc_id long, text string").toPandas()
    drawn, draw = [], fingerprint.draw
    monkeypatch.setattr(fingerprint, "draw", lambda w, salts: drawn.append(w.size if w.shape[-1] == 1 else 0) or draw(w, salts))
    monkeypatch.setattr(fingerprint, "sampler", lambda: fingerprint.Sampler(cached=1))
    got = next(fingerprint._compare(iter([rows])))
    assert len(got) == 3
    assert sum(drawn) <= len(words) + 8  # words cut by the edit are new
