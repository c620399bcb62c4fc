import pytest
from pyspark.sql import functions as F

from bitexture.functions import text as txt
from bitexture.functions.hashing import seeded_hash
from bitexture.functions.prompts import (
    FixedPrompt,
    Template,
    TemplatePrompt,
    by_start_language,
    cut_closing_marker,
    template_grid,
)
from bitexture.functions.tokens import (
    codepoint_ids,
    fixed_length_rows,
    loss_labels,
    pad_right,
    padding_mask,
    real_length,
    with_special_ids,
)
from bitexture.functions.wrappers import AffixWrapper, get_wrapper, system_wrapper

ODD_TEXTS = [
    "",
    "plain",
    "  both  ",
    " nbsp　",
    "\tTab\n",
    "​zero width stays​",
    "in side",
    "{input} {output} {}",
    'quo"te\\',
    "emoji \U0001F600 é",
    "\x1cfs\x85",
]


def column_of(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_strip_matches_python(spark):
    assert column_of(spark, ODD_TEXTS, txt.strip(F.col("t"))) == [t.strip() for t in ODD_TEXTS]
    assert column_of(spark, ODD_TEXTS, txt.right_strip(F.col("t"))) == [t.rstrip() for t in ODD_TEXTS]
    assert column_of(spark, ODD_TEXTS, txt.without_spaces(F.col("t"))) == ["".join(t.split()) for t in ODD_TEXTS]


def test_counters(spark):
    assert column_of(spark, ODD_TEXTS, txt.count_chars(F.col("t"))) == [len(t) for t in ODD_TEXTS]
    assert column_of(spark, ODD_TEXTS, txt.count_bytes(F.col("t"))) == [len(t.encode()) for t in ODD_TEXTS]
    assert column_of(spark, ["", " a  b ", "x"], txt.count_words(F.col("t"))) == [0, 2, 1]


def test_harmonic_mean_of_zeros_is_null(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.5, 1.0), (None, 1.0)], "a double, b double")
    got = [r[0] for r in df.select(txt.harmonic_mean(F.col("a"), F.col("b"))).collect()]
    assert got == [None, pytest.approx(2 / 3), None]


def test_hash_is_stable_and_seeded(spark):
    import hashlib

    got = spark.range(3).select(seeded_hash("id", 7), seeded_hash("id", 8)).collect()
    for i, row in enumerate(got):
        assert row[0] == int(hashlib.md5(f"{i}|7".encode()).hexdigest()[:8], 16)
        assert row[0] != row[1]


def test_fixed_prompt(spark):
    prompt = FixedPrompt({"en": "ENGLISH", "fr": "fr"}, "GO:")
    t = F.col("t")
    assert column_of(spark, ["a"], prompt.train(t, F.lit("b"), "en")) == ["GO: ENGLISH: a fr: b"]
    assert column_of(spark, ["a"], prompt.query(t, "fr")) == ["GO: fr: a ENGLISH: "]
    assert column_of(spark, ["a"], FixedPrompt({"en": "en", "fr": "fr"}).query(t, "en")) == ["en: a fr: "]
    with pytest.raises(ValueError, match="no heading for de"):
        prompt.query(t, "de")


def test_start_language_column(spark):
    prompt = FixedPrompt({"en": "en", "fr": "fr"})
    rendered = {lang: prompt.query(F.lit("x"), lang) for lang in ("en", "fr")}
    assert column_of(spark, ["fr"], by_start_language(F.col("t"), rendered)) == ["fr: x en: "]
    with pytest.raises(Exception, match="unknown start language de"):
        column_of(spark, ["de"], by_start_language(F.col("t"), rendered))


def test_templates_keep_placeholder_like_text(spark):
    prompt = TemplatePrompt({"en": [Template.parse("A {input} B {output} C")]})
    got = column_of(spark, ["{output}"], prompt.train(F.col("t"), F.lit("{input}"), "en"))
    assert got == ["A {output} B {input} C"]
    assert column_of(spark, ["x"], prompt.query(F.col("t"), "en")) == ["A x B  C"]


@pytest.mark.parametrize("wording", ["none", "{input}", "{output} {input}", "{input}{output}{input}"])
def test_templates_need_both_placeholders(wording):
    with pytest.raises(ValueError, match="template needs"):
        Template.parse(wording)


def test_round_robin_and_random_choice(spark):
    wordings = [Template.parse(f"{i} {{input}}{{output}}") for i in range(3)]
    calls = spark.range(30)
    robin = TemplatePrompt({"en": wordings})
    got = [r[0] for r in calls.orderBy("id").select(robin.query(F.lit(""), "en", F.col("id"))).collect()]
    assert got == [f"{i % 3} " for i in range(30)]
    drawn = TemplatePrompt({"en": wordings}, random_choice=True)
    first = [r[0] for r in calls.orderBy("id").select(drawn.query(F.lit(""), "en", F.col("id"))).collect()]
    again = calls.repartition(7).orderBy("id").select(drawn.query(F.lit(""), "en", F.col("id"))).collect()
    assert first == [r[0] for r in again] and set(first) == {"0 ", "1 ", "2 "}
    with pytest.raises(ValueError, match="no templates"):
        robin.query(F.lit(""), "hr")


def test_closing_marker(spark):
    assert column_of(spark, ["q<end_of_turn>\n"], cut_closing_marker(F.col("t"))) == ["q"]
    with pytest.raises(Exception, match="closing marker"):
        column_of(spark, ["q"], cut_closing_marker(F.col("t")))


def test_wrappers(spark):
    both = lambda name: column_of(
        spark, ["I"], F.array(get_wrapper(name).train(F.col("t"), F.lit("R")), get_wrapper(name).query(F.col("t")))
    )[0]
    assert both(None) == ["I", "I"]
    assert both("MISTRAL-7B-Instruct") == both("mistral-instruct") == ["<s>[INST] I [/INST]R</s>", "[INST] I [/INST]"]
    assert both(system_wrapper("S")) == [
        "<s>[INST] <<SYS>>\nS\n<</SYS>>\n\nI [/INST]R</s>",
        "<s>[INST] <<SYS>>\nS\n<</SYS>>\n\nI [/INST]",
    ]
    assert both("gemma-instruct") == both("gemma-it")
    assert both("gemma-it")[1] == "<start_of_turn>user\nI<end_of_turn>\n<start_of_turn>model\n"
    assert both(AffixWrapper("<", "|", ">")) == ["<I|R>", "<I|"]
    with pytest.raises(ValueError, match="gemma-it"):
        get_wrapper("other")


def test_template_grid_has_no_self_pairs():
    names = {"en": {lang: {"n": lang.upper()} for lang in ("en", "fr", "de")}}
    grid = template_grid(names, {"en": ["{source:n}>{target:n} {input}{output}", "{target:n} {input}{output}"]})["en"]
    assert {k: len(v) for k, v in grid.items()} == {"en": 4, "fr": 4, "de": 4}
    assert grid["en"][0] == "EN>FR {input}{output}"


def test_token_arrays(spark):
    text = "aé世\U0001F600"
    assert column_of(spark, [text, ""], codepoint_ids(F.col("t"))) == [[ord(c) for c in text], []]
    ids = F.array(F.lit(5), F.lit(6), F.lit(7))
    assert column_of(spark, ["x"], pad_right(ids, 5, 9)) == [[5, 6, 7, 9, 9]]
    assert column_of(spark, ["x"], pad_right(ids, 2, 9)) == [[5, 6]]
    assert column_of(spark, ["x"], padding_mask(ids, 5)) == [[1, 1, 1, 0, 0]]
    assert column_of(spark, ["x"], padding_mask(ids, 2)) == [[1, 1]]
    assert column_of(spark, ["x"], loss_labels(ids, 6)) == [[5, -100, 7]]
    assert column_of(spark, ["x"], real_length(ids, 7)) == [2]
    assert column_of(spark, ["x"], real_length(ids, 8)) == [3]
    assert column_of(spark, ["x"], with_special_ids(ids, [1], [2])) == [[1, 5, 6, 7, 2]]


def test_fixed_length_rows_drop_the_text(spark):
    df = spark.createDataFrame([("ab",)], "text string")
    row = fixed_length_rows(df, codepoint_ids(F.col("text")), 3, 0).first()
    assert row.asDict() == {"input_ids": [97, 98, 0], "attention_mask": [1, 1, 0], "labels": [97, 98, 0]}
