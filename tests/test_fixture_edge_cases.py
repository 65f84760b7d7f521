"""Hand-made edge cases listed in FIXTURES.md §1."""

from pyspark.sql import functions as F

from textlab.functions import text as T
from textlab.functions.tokens import ngrams, tokens
from textlab.operators import labels as L


def test_list_join_null_empty_and_null_element(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["a", None, "b"]), (4, ["x"])], "id int, l array<string>")
    got = {r.id: r.s for r in df.select("id", T.list_join("l").alias("s")).collect()}
    assert got == {1: "", 2: "", 3: "a, b", 4: "x"}
    back = {r.id: r.p for r in df.select("id", T.list_split(T.list_join("l")).alias("p")).collect()}
    assert back[3] == ["a", "b"] and back[2] == [""]


def test_title_repeated_and_section_words(spark):
    df = spark.createDataFrame(
        [("Hilfe", "Hilfe für alle. Kurztext Hilfe bleibt. Volltext Ziel und Gegenstand: Hilfe  "), ("", "kein Titel"),
         ("T", None)], "title string, text string")
    r = df.select(T.strip_title("text", "title").alias("a"),
                  T.strip_section_words(T.strip_title("text", "title")).alias("b")).collect()
    assert r[0].a == " für alle. Kurztext  bleibt. Volltext Ziel und Gegenstand:   "
    assert r[0].b == "für alle.   bleibt.  :"
    assert r[1].a == "kein Titel"  # empty title: unchanged
    assert r[2].a is None


def test_templates(spark):
    df = spark.createDataFrame([("Prog", "Bund, Land", "Vereine", "Prog: Text über Prog.")],
                               "title string, area string, app string, text string")
    r = df.select(T.title_cats_compact("title", "area", "app", "text").alias("c"),
                  T.cats_md("text", "area", "app").alias("m")).first()
    assert r.c == "Prog (Förderbereich: Bund, Land; Förderberechtigte: Vereine): : Text über ."
    assert r.m == "Prog: Text über Prog.\n\n---\n\nFörderbereich: Bund, Land\n\nFörderberechtigte: Vereine"


def test_tokens_empty_null_and_strict(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "ESF+ z.B. aus- Förderung 2024 gut")], "id int, t string")
    got = {r.id: (r.loose, r.strict) for r in df.select(
        "id", tokens("t").alias("loose"), tokens("t", strict=True).alias("strict")).collect()}
    assert got[1] == ([], []) and got[2] == ([], [])
    assert got[3][0] == ["esf", "z", "b", "aus", "förderung", "2024", "gut"]
    assert got[3][1] == ["förderung", "2024", "gut"]


def test_ngrams_short_arrays(spark):
    df = spark.createDataFrame([(1, []), (2, ["a"]), (3, ["a", "b", "c"])], "id int, t array<string>")
    got = {r.id: r.g for r in df.select("id", ngrams("t", 1, 3).alias("g")).collect()}
    assert got == {1: [], 2: ["a"], 3: ["a", "b", "c", "a b", "b c", "a b c"]}


def test_html_chains(spark):
    html = ('<html><head><style>p{x}</style><script>var a="<p>";</script></head><body>'
            '<!-- c --><h2 class="t">Ziel</h2><p>Eins &amp; <b>zwei</b> <a href="https://x.org/a">Link</a></p>'
            '<ul><li>A</li><li><em>B</em></li></ul><br/><div onclick="x">Rest</div></body></html>')
    df = spark.createDataFrame([(html,)], "h string")
    r = df.select(T.html_to_text("h").alias("t"), T.html_to_md("h").alias("m"), T.html_clean("h").alias("c")).first()
    assert r.t == "Ziel Eins & zwei Link A B Rest"
    assert r.m == "## Ziel\n\nEins & **zwei** [Link](https://x.org/a)\n\n- A\n- *B*\nRest"
    assert r.c == "<h2>Ziel</h2><p>Eins &amp; <b>zwei</b> Link</p><ul><li>A</li><li><em>B</em></li></ul><br>Rest"


def test_majority_tie_and_duplicate_ids(spark):
    rounds = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), ("b", 0), ("b", 1), ("c", None)],
                                   "id_hash string, label bigint")
    maj = {r.id_hash: r.label for r in L.majority_label(rounds, "id_hash", "label").collect()}
    assert maj == {"a": 1, "b": 0}  # tie goes to the positive label; null labels ignored
    assert L.duplicate_keys(rounds, "id_hash").count() == 2
    gt = spark.createDataFrame([("a", 0, 1), ("a", 1, 2)], "id_hash string, gt_label bigint, ver int")
    fixed = {r.id_hash: r.label for r in L.apply_corrections(
        rounds.dropDuplicates(["id_hash"]), gt, "id_hash", truth_order="ver").collect()}
    assert fixed["a"] == 1 and fixed["b"] == 0  # newest truth row wins, rows do not multiply


def test_mixed_vocabularies(spark):
    df = spark.createDataFrame([("yes",), ("no",), ("dfy",), ("dfn",), ("maybe",), (None,)], "c string")
    got = [r.l for r in df.select(L.choice_label(F.col("c")).alias("l")).collect()]
    assert got == [1, 0, 1, 0, None, None]
