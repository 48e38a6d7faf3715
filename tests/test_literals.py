"""Python literals as JSON, against Python's own reader."""

import ast
import json
import random

import pytest
from pyspark.sql import functions as F

from gripline.functions.literals import literal_json
from gripline.functions.replies import parse_grounding

FORMS = [
    "{'c': .5}", "{'n': -1.}", "{'bbox': [0x10, 2, 3, 4]}", "{'c': 1_000}", "{'target_object': u'cup'}", "{'s': 'a' 'b'}", "('cup')", "{'a': ('cup')}",
    "{'a': ('cup',)}", "{'a': ()}", "{'a': (1, [2, (3)], {'b': (4,)})}", "[{'a': 1},]", "{'a': [1, 2,], 'b': {'c': 1,},}", "{'a': None, 'b': True, 'c': False}",
    r"""{'a': 'it\'s', 'b': "say \"x\""}""", r"{'a': '\x41\u00e9\t\n\101\a\v\d\0'}", r"{'a': r'\d+\n'}",
    "{'a': '''x 'y' ''z'''}", '{"a": """q " w "" e"""}', "{'a': 'x, [y] (z) {w}: #'}", "{3: 'a', -2.5: 'b', None: 'c', True: 'd'}", "{'a': +5, 'b': - 3, 'c': 1e3, 'd': 1.5E-2, 'e': 1_0.2_5, 'f': 00, 'g': 0b101, 'h': 0o17, 'i': 0XfF}",
    "{'a': '', 'b': '' '', 'c': ((1))}", "{'a': [[], [[]], ((),)]}", "{ }", "[ ]", "{'a':1}  ", "{'a': 'new\\\nline'}", "{'a': [True,False , None]}", "{'a': 'ä€\U0001f600'}", "{'a': ( 'x' 'y' )}", "{'a': 'tab\there'}", "'only text'", "-5", "3.", "{'a': 1 , }",
]
BROKEN = ["{'a': 01}", "{'a': 1__0}", "{'a': nan}", "{'a': NaN}", "{'a': 1 2}", "{'a': [,]}", "{,}", "{'a': 'x\ny'}", "{'a': 'x}", "{'a': b}", "[1, 2", "{'a': 1 - 2}", "{'a': (1, 2]}", "", "?", "{'a': --5}", "{'a': 0x}", "{'a' 1}", "{'a': 1,,}", "{'a': [1 'x']}", "(", ")", "{'a': 5k}"]


def read(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    checked = F.try_parse_json(F.col("j"))
    got = rows.withColumn("j", literal_json(F.col("t"))).select("i", F.when(checked.isNotNull(), F.col("j")).alias("j")).collect()
    return [r.j for r in sorted(got)]


def plain(value):
    """A literal as JSON has it: tuples as lists, keys as texts."""
    if isinstance(value, dict):
        return {k if isinstance(k, str) else json.dumps(k): plain(v) for k, v in value.items()}
    return [plain(v) for v in value] if isinstance(value, (list, tuple)) else value


def test_forms(spark):
    for text, got in zip(FORMS, read(spark, FORMS), strict=True):
        want = ast.literal_eval(text)
        if isinstance(want, tuple):
            assert got is None, text
        else:
            assert got is not None and json.loads(got) == plain(want), (text, got)


def test_broken(spark):
    for text, got in zip(BROKEN, read(spark, BROKEN), strict=True):
        with pytest.raises((ValueError, SyntaxError)):
            ast.literal_eval(text)
        assert got is None, (text, got)


def test_random_literals(spark):
    r = random.Random(5)
    letters = "ab'\"\\,:[](){} \t\nä\x01\x02é\U0001f600#"

    def value(depth):
        k = r.randrange(9 if depth else 5)
        if k == 0:
            return r.choice([None, True, False])
        if k == 1:
            return r.choice([0, -7, 12345, 2.5, -1e-3, 1e22])
        if k < 5:
            return "".join(r.choice(letters) for _ in range(r.randrange(8)))
        if k == 5:
            return tuple(value(depth - 1) for _ in range(r.randrange(4)))
        if k == 6:
            return [value(depth - 1) for _ in range(r.randrange(4))]
        return {r.choice(["k", "a'b", "x,y", 3, "é"]): value(depth - 1) for _ in range(r.randrange(4))}

    texts = [repr({"v": value(4)}) for _ in range(400)]
    for text, got in zip(texts, read(spark, texts), strict=True):
        assert got is not None and json.loads(got) == plain(ast.literal_eval(text)), (text, got)


def test_long_strings(spark):
    """Very long texts and many tokens do not exhaust the reader."""
    texts = [repr({"target_object": "it's " + "word, [x] \\ \"q\" " * 20_000}), repr({"target_object": list(range(3000)), "b": ["x'"] * 2000})]
    for text, got in zip(texts, read(spark, texts), strict=True):
        assert json.loads(got) == ast.literal_eval(text)


def test_strings_are_set_aside(spark):
    """Strings of any signs come back whole and in their places, joined where they are adjacent; none is taken for structure."""
    signs = "".join(map(chr, range(1, 32))).replace("\n", "").replace("\r", "")
    texts = [f"{{'a': 'x{signs}y', 'b\x0e0\x0f': [u'1' r'\\2' \"\"\"3\n\"\"\", '']}}", "{'\\x0e1\\x0f': '\x0e1\x0f', 'b': ('\x0e0\x0f',)}", "['''''', R'\x0c', U\"'\", '\\\\' '\\'']"]
    for text, got in zip(texts, read(spark, texts), strict=True):
        assert got is not None and json.loads(got) == plain(ast.literal_eval(text)), (text, got)
    broken = ["{'a': '\\x4', 'b': 1}", "['\\u12', 'x']", "['\\u12' 'x']", "['x' '\\xg']", "{'a': \x0e0\x0f}", "['a', \"\x0e0\x0f]", "['a\x00']"]
    assert read(spark, broken) == [None] * len(broken)


def test_replies(spark):
    rows = [("({'target_object': 'cup'},)", None), ("[{'target_object': u'cup', 'c': .5}]", {"target_object": "cup", "c": 0.5}), ("Response: {'a': 0x10,}", {"a": 16}), ("('cup')", None)]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, t string")
    got = {r.i: r.g for r in frame.select("i", parse_grounding(F.col("t")).alias("g")).collect()}
    assert [None if got[i] is None else json.loads(got[i]) for i in range(len(rows))] == [w for _, w in rows]
