"""Lines of every length: equal ones, and near ones by the class of their length."""

import random
import re

from rollcall.llm import line_dedup
from tests.llm.test_llm import edit_distance


def edits(n, ladder):
    return max((k for least, k in ladder if n >= least), default=-1)


def close(x, y, ladder):
    most = edits(max(len(x), len(y)), ladder)
    if abs(len(x) - len(y)) > most:
        return False
    while x and y and x[0] == y[0]:
        x, y = x[1:], y[1:]
    while x and y and x[-1] == y[-1]:
        x, y = x[:-1], y[:-1]
    return edit_distance(x, y) <= most


def near(a, b):
    if min(len(a), len(b)) < line_dedup.NEAR_FROM:
        return False
    x, y = (re.findall(r"[\x21-\x7E]+|[^\x00-\x7F]", t) for t in (a, b))
    return close(a, b, line_dedup.CHARACTERS) or close(x, y, line_dedup.TOKENS)


def test_links_of_all_length_classes_equal_brute_force(spark):
    rng = random.Random(6)
    lines = ["}", "Yes.", "Contents", "Contexts", "Chapter one", "Chapter on"]
    for n, letters in ((2, "abcdef"), (4, "abcdef"), (6, "abcdef"), (17, "abcdef"), (33, "abcdef"), (50, "abcdef"), (66, "abcdef"), (70, "\u4e00\u4e01\u4e02\u4e03")):
        for _ in range(3):
            words = ["".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n)]
            lines.append(" ".join(words))
            for _ in range(5):
                cut = list(words)
                for _ in range(rng.randint(1, 5)):
                    at = rng.randrange(len(cut))
                    cut[at : at + rng.randint(0, 1)] = rng.choice([["replacement"], [], ["x" + cut[at]], [cut[at][1:] or "y"]])
                lines.append(" ".join(cut).strip() or "empty")
    lines += ["}", "Yes."]
    first = {line: i for i, line in reversed(list(enumerate(lines)))}
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_lines"], r["n_exact"], r["n_links"]) for r in line_dedup.report(docs).collect()}
    links = {x: sum(near(x, y) for y in first if y != x) for x in first}
    assert got == {i: (1, int(first[x] != i), links[x]) for i, x in enumerate(lines)}
    assert sum(links.values()) > 100


def test_a_long_line_with_one_word_replaced_is_dropped(spark):
    words = [f"{x}word" for x in "abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrstuvwxyz"]
    other = [*words[:20], "something-else-entirely", *words[21:]]
    docs = spark.createDataFrame([(1, "}\n" + " ".join(words)), (2, " ".join(other) + "\n}")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(docs).collect()} == {1: "}\n" + " ".join(words), 2: ""}
