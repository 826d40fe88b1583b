"""Edge rows of the text and JSON transforms."""

import json

from pyspark.sql import functions as F

from turnpress.functions import chat, spans, text, tools


def test_strip_is_unicode_aware(apply):
    values = [" 　\x1c a b\x85 ", "", " ", "x​"]
    assert apply(values, text.strip) == [v.strip() for v in values]


def test_whitespace_set_is_complete():
    assert set(text.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_spaced_json(apply):
    objects = [{"a": {"x": 1, "y": 'p,q:r"s\\'}, "b": [1, 2.5, None], "c": []}, {}, {"é": "\n,:"}]
    compact = [json.dumps(o, ensure_ascii=False, separators=(",", ":")) for o in objects]
    spaced = [json.dumps(o, ensure_ascii=False) for o in objects]
    assert apply(compact, text.spaced_json) == apply(spaced, text.spaced_json) == spaced


def test_spaced_json_survives_many_escapes(apply):
    big = json.dumps({"a": "\n" * 300_000, "b": 1}, separators=(",", ":"))
    assert apply([big], lambda c: F.length(text.spaced_json(c))) == [len(json.dumps(json.loads(big)))]


def test_is_json(apply):
    cases = {
        '{"x": 1}': True, "5": True, ' "a" ': True, "null": True, '{"a":1} x': False, "1,2": False,
        "": False, "1],[2": False, "not json": False, "{'a':1}": False, '1,"x":2': False, None: False,
    }
    assert apply(list(cases), text.is_json) == list(cases.values())


def test_json_list(apply):
    cases = {
        '["a", {"b": 1}]': ["a", '{"b":1}'], "[]": [], "{}": None, "[": None, '["a"] junk': None,
        "[1],[2]": None, '["a"], "x": ["b"]': None, '["a"]} ["b"]': None, "": None, None: None,
        "\n [1] ": ["1"], '"[1]"': None, "null": None,
    }
    assert apply(list(cases), text.json_list) == list(cases.values())


def test_list_of_objects(apply):
    cases = {'[{"name": "f"}]': True, '["{\\"name\\": 1}"]': False, '[{"a": ["{x"]}]': True}
    assert apply(list(cases), text.list_of_objects) == list(cases.values())


def test_brace_spans(apply):
    cases = {
        'say {"a": "}\\""} and {"b":{}} {': ['{"a": "}\\""}', '{"b":{}}'],
        'it is 5" wide {"name":"f"}': [],
        "}} {a} }{": ["{a}"],
        '\\" {x} " {y}': ["{y}"],
        "ééé {ü} {": ["{ü}"],
        "": [],
    }
    assert apply(list(cases), spans.brace_spans) == list(cases.values())


def test_brace_spans_are_those_that_were_put_in(apply):
    import random

    rng = random.Random(7)
    fillers = ["", " ", "é\n", "} ", '"in a {string}" ', '"\\" {" ', "\x01", "\x01e\x01s", "plain \\ text "]
    inner = ["", "a", '"}"', '"\\\\"', "{}", "{x{y}}", '"{"', "\x01", "é: 1"]

    def span(parts):
        return "{" + "".join(rng.choice(inner) for _ in range(parts)) + "}"

    built = [[span(rng.randrange(6)) for _ in range(rng.choice([0, 1, 3, 300]))] for _ in range(300)]
    texts = ["".join(rng.choice(fillers) + s for s in spans_) + rng.choice(["", "{ never closed", "tail"]) for spans_ in built]
    assert apply(texts, spans.brace_spans) == built
    offsets = apply(texts, spans.brace_objects)
    assert [[o["span"] for o in found] for found in offsets] == built
    assert [[t[o["start"] - 1 : o["start"] - 1 + o["len"]] for o in found] for t, found in zip(texts, offsets)] == built


def test_spans_of_any_depth_and_behind_open_braces(apply):
    """Deeper than one expression goes, and all that follows such an object, are folded."""
    deep = ["{" * n + '"}"' + "}" * n for n in (1, spans.DEPTH, spans.DEPTH + 1, 500)]
    texts = ["é" + " \U0001f600 ".join(deep) + " {a} {", '{"open} ' + "{}" * 5, "{a{b}", '{a} {"b\\', "{\n}{\r\n}\n"]
    want = [[*deep, "{a}"], [], [], ["{a}"], ["{\n}", "{\r\n}"]]
    assert apply(texts, spans.brace_spans) == want
    found = apply(texts, spans.brace_objects)
    assert [[o["span"] for o in row] for row in found] == want
    assert [[t[o["start"] - 1 : o["start"] - 1 + o["len"]] for o in row] for t, row in zip(texts, found)] == want


def test_many_spans_take_linear_time(apply):
    import time

    def seconds(n):
        start = time.perf_counter()
        assert apply(["{} " * n], lambda c: F.struct(F.size(spans.brace_spans(c)), F.size(spans.brace_objects(c)).alias("m")))[0]["m"] == n
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(100_000) < 10 * max(seconds(25_000), 0.5)

    def unclosed(n):
        start = time.perf_counter()
        assert apply(["{ " * n], spans.brace_spans) == [[]]
        return time.perf_counter() - start

    assert unclosed(100_000) < 10 * max(unclosed(25_000), 0.5)


def _objects(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = spans.with_objects(df.withColumn("o", F.array("t")), "o", "o").withColumn("o", F.get("o", F.lit(0)))
    fields = F.from_json("o", "name string, arguments string, a variant, b variant", text.LENIENT)
    return [(r["o"], r["j"]) for r in out.select("i", "o", F.to_json(fields).alias("j")).orderBy("i").collect()]


def test_permissive_object(spark):
    cases = {
        '{"name": "f", "arguments": \'{"x": 1}\'}': {"name": "f", "arguments": '{"x": 1}'},
        "{'a': True, 'b': None}": {"a": True, "b": None},
        "{'a': true}": None, "[1]": None, "5": None, "": None, "{": None,
        "{'a': 'it\\'s'}": {"a": "it's"}, "{'a': '\\x41'}": {"a": "A"}, "{'a': (1, 2)}": {"a": [1, 2]},
        '{"a": null}': {"a": None},
    }
    for (text_, want), (value, fields) in zip(cases.items(), _objects(spark, list(cases))):
        assert (value is None) == (want is None), text_
        if want is not None:
            assert json.loads(fields) == want, text_


def _fn(name, description="", parameters="{}"):
    return {"type": "function", "function": {"name": name, "description": description, "parameters": parameters}}


def test_tool_spec(apply):
    cases = [
        ('{"name": ""}', _fn("")),
        ('{"name": 5}', None),
        ("{}", None),
        ('{"type":"function","function":{"name":"g","extra":1},"more":2}', _fn("g")),
        ('{"type":"function","function":"g","name":"h"}', _fn("h")),
        ('{"name":"f","description":null,"parameters":null}', _fn("f")),
        ('{"name":"f","description":0,"parameters":[]}', _fn("f")),
        ('{"name":"f","description":"d","parameters":{"b":{"z":1},"a":"x,y"}}',
         _fn("f", "d", '{"b": {"z": 1}, "a": "x,y"}')),
        ('{"name":"f","parameters":"{}"}', _fn("f", "", '"{}"')),
        ('{"name":"f","parameters":{"a":1,"a":2}}', _fn("f", "", '{"a": 1, "a": 2}')),
        (None, None),
    ]
    out = apply([c for c, _ in cases], lambda c: F.get(tools.tool_specs(F.array(c)), F.lit(0)))
    for (text_, want), got in zip(cases, out):
        assert got == want, text_


def test_tool_call(apply):
    def call(name, arguments):
        return {"type": "function", "function": {"name": name, "arguments": arguments}}

    cases = [
        ('{"name":"f"}', call("f", "{}")),
        ('{"name":"f","arguments":null}', None),
        ('{"name":"f","arguments":5}', None),
        ('{"name":"f","arguments":[1]}', None),
        ('{"name":"f","arguments":"{\\"x\\": 1}"}', call("f", '{"x": 1}')),
        ('{"name":"f","arguments":"{\\"x\\":  1 }"}', call("f", '{"x":  1 }')),
        ('{"name":"f","arguments":"not json"}', None),
        ('{"name":"f","arguments":"5"}', call("f", "5")),
        ('{"name":"f","arguments":{"x":1.50,"w":"a"}}', call("f", '{"x": 1.5, "w": "a"}')),
        ('{"arguments":{}}', None),
        ("{\"name\": \"f\", \"arguments\": '{\"x\": 1}'}", call("f", '{"x": 1}')),
    ]
    out = apply([c for c, _ in cases], lambda c: F.get(tools.tool_calls(F.array(c)), F.lit(0)))
    for (text_, want), got in zip(cases, out):
        assert got == want, text_


def test_declared_tools_skip_bad_spans(spark):
    df = spark.createDataFrame([('x {"name":"f"} {"no":1} {bad} {"name":"g"} {\'name\': \'h\', \'parameters\': None}',)], "system string")
    row = tools.with_declared_tools(df).select(tools.tool_names(F.col("tools")).alias("n")).first()
    assert row["n"] == ["f", "g", "h"]


def _turns(apply, values):
    return [[(t["role"], t["content"]) for t in row] for row in apply(values, chat.role_turns)]


def test_role_turns(apply):
    got = _turns(apply, [
        "USER: hi\n\n\nASSISTANT: \n\n\nUSER: x",
        "preamble\nUSER: a",
        "USER: see USER: y",
        "  USER: a <|endoftext|>\n\n FUNCTION RESPONSE: {}\nASSISTANT:b",
        "<|endoftext|> \n",
        "no roles",
        "USER: a\x85USER: b",
    ])
    assert got == [
        [("USER", "hi"), ("USER", "x")],
        [("USER", "a")],
        [("USER", "see USER: y")],
        [("USER", "a"), ("FUNCTION RESPONSE", "{}"), ("ASSISTANT", "b")],
        [], [],
        [("USER", "a\x85USER: b")],
    ]


def test_preamble_with_role_word_shifts_pairs(apply):
    assert _turns(apply, ["USER says\nASSISTANT: b"]) == [[("USER says", "ASSISTANT")]]


def _parse(spark, chats):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(chats)], "ord bigint, chat string")
    return [r["messages"] for r in chat.with_messages(df).orderBy("ord").collect()]


def test_assistant_turns(spark):
    rows = _parse(spark, [
        "USER: hello\nASSISTANT: ok <functioncall> {\"name\":\"f\",\"arguments\":'{}'} tail",
        "USER: hello\nASSISTANT: <functioncall> {\"name\":",
        "USER: hello\nASSISTANT: no",
        "USER: hey\nASSISTANT: no",
        "USER: hello\nASSISTANT: <functioncall> {'name': 'f', 'arguments': {'a': True}}\nFUNCTION RESPONSE: 1",
        "",
        "USER says\nASSISTANT: b",
    ])
    assert rows[0][1]["content"] == "ok"
    assert [c["function"]["name"] for c in rows[0][1]["tool_calls"]] == ["f"]
    assert rows[0][1]["tool_calls"][0]["function"]["arguments"] == "{}"
    assert rows[1] is None and rows[3] is None and rows[5] is None and rows[6] is None
    assert [m["role"] for m in rows[2]] == ["user", "assistant"]
    assert rows[2][1]["tool_calls"] is None
    assert rows[4][1]["tool_calls"][0]["function"]["arguments"] == '{"a": true}'
    assert rows[4][2]["role"] == "tool"


def test_call_offsets(apply):
    value = 'ok <functioncall> {"a": {}} tail'
    assert apply([value], chat.call_start) == [3]
    assert apply([value], chat.call_end) == [len('ok <functioncall> {"a": {}}')]
