"""Nested records against a plain recursive walk."""

import json

import pytest

from folioloom.operators.shred import PARSED_PAGES, _dumps, _loads, flatten, level_columns, shred


def walk(payload):
    """Brute force: (page_no, list, path, line, span) of every span object."""
    try:
        v = json.loads(payload)
        while isinstance(v, str):
            v = json.loads(v)
    except (TypeError, ValueError):
        return
    if not isinstance(v, dict):
        return
    many = lambda x: x if isinstance(x, list) else [x] if isinstance(x, dict) else []

    def block(b, path):
        if not isinstance(b, dict):
            return
        for i, line in enumerate(many(b.get("lines"))):
            if isinstance(line, dict):
                for j, s in enumerate(many(line.get("spans"))):
                    if isinstance(s, dict):
                        yield path, i, j
        for i, x in enumerate(many(b.get("blocks"))):
            yield from block(x, f"{path}.{i}")

    for p, page in enumerate(many(v["pdf_info"]) if v.get("pdf_info") is not None else [v]):
        if isinstance(page, dict):
            for name in ("para_blocks", "discarded_blocks"):
                for i, b in enumerate(many(page.get(name))):
                    for found in block(b, str(i)):
                        yield p, name, *found


SPAN = {"type": "text", "content": "x"}
CASES = [
    None,
    "",
    "not json",
    "[]",
    "17",
    '{"para_blocks": [',
    json.dumps({"para_blocks": [None, {"lines": [{"spans": [None, SPAN, {}]}, None, {"spans": SPAN}]}]}),
    json.dumps({"para_blocks": {"lines": {"spans": SPAN}}, "discarded_blocks": None, "preproc_blocks": [{"lines": [{"spans": [SPAN]}]}]}),
    json.dumps({"pdf_info": [None, {"para_blocks": [{"blocks": [None, {"blocks": {"lines": [{"spans": [SPAN, SPAN]}]}}], "lines": [{"spans": []}]}]}]}),
    json.dumps({"pdf_info": {"discarded_blocks": [{"lines": [{"spans": [{"children": [SPAN], "content": "a"}]}]}]}}),
    json.dumps(json.dumps({"para_blocks": [{"lines": [{"spans": [SPAN]}]}]})),
    json.dumps({"para_blocks": [[SPAN], 3, "s", {"lines": "x"}, {"lines": [5, {"spans": [4, SPAN]}]}]}),
]


def found(spark, rows):
    df = spark.createDataFrame(rows, "rec_id long, payload string, page_no string, rep string")
    return sorted(map(tuple, flatten(df, "span", keys_only=True).collect()))


def test_matches_walk_on_all_shapes(spark):
    rows = [(i, p, "clash", "clash") for i, p in enumerate(CASES)]
    assert found(spark, rows) == sorted((i, *x) for i, p in enumerate(CASES) for x in walk(p))


def test_deep_and_repeated_records(spark):
    b = {"lines": [{"spans": [SPAN]}]}
    for _ in range(150):
        b = {"blocks": [None, b], "lines": [{"spans": [SPAN]}]}
    deep = json.dumps({"para_blocks": [b]})
    got = found(spark, [(1, deep, "", ""), (1, deep, "", "")])
    assert got == sorted([(1, *x) for x in walk(deep)] * 2) and len(got) == 302


def nested(depth, text):
    return '{"blocks": [' * depth + '{"lines": [{"spans": [{"type": "text", "content": ' + text + "}]}]}" + "]}" * depth


def test_nesting_beyond_the_recursive_reader(spark):
    n = 12_000
    with pytest.raises(RecursionError):
        json.loads("[" * 10 * n + "]" * 10 * n)
    deep = '{"para_blocks": [' + nested(n, '"x"') + "]}"
    assert found(spark, [(1, deep, "", ""), (2, deep[:-1], "", "")]) == [(1, 0, "para_blocks", ".".join("0" * (n + 1)), 0, 0)]
    far = "[" * 10 * n + "1" + "]" * 10 * n
    rows = spark.createDataFrame([(1, '{"para_blocks": [' + nested(0, far) + "]}")], "rec_id long, payload string")
    assert [r.content for r in flatten(rows, "span").collect()] == [far]


def test_reader_with_a_stack_reads_like_the_recursive_one(monkeypatch):
    texts = [c for c in CASES if c] + ['{"a": {}, "b": [], "c": [1, -2.5e3, true, false, null, "\\u00e9\\n"]}', "[1,]", '{"a" 1}', "{1: 2}", "[1 2]", "[] x", " ", '{"a": 1,}']
    plain = []
    for x in texts:
        try:
            plain.append(json.loads(x))
        except ValueError:
            plain.append(ValueError)
    written = [json.dumps(v, ensure_ascii=False) for v in plain if v is not ValueError]

    def fails(*args, **kwargs):
        raise RecursionError

    real = json.dumps
    monkeypatch.setattr(json, "loads", fails)
    monkeypatch.setattr(json, "dumps", lambda v, **k: fails() if isinstance(v, (list, dict)) and v else real(v, **k))
    for x, want in zip(texts, plain, strict=True):
        if want is ValueError:
            with pytest.raises(ValueError):
                _loads(x)
        else:
            assert _loads(x) == want
    assert [_dumps(v) for v in plain if v is not ValueError] == written


def test_empty_table(spark):
    assert found(spark, []) == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/middle_json.parquet")
    got = sorted(map(tuple, flatten(df, "span", keys_only=True).collect()))
    assert got == sorted((r.rec_id, *x) for r in df.collect() for x in walk(r.payload))


def test_rows_name_their_parents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/middle_json.parquet")
    pages, blocks, lines, spans = (flatten(df, k) for k in ("page", "block", "line", "span"))
    key = ["rec_id", "page_no"]
    assert blocks.join(pages, key, "left_anti").isEmpty()
    up = blocks.selectExpr("rec_id", "page_no", "block_list", "block_path as parent_path").distinct()
    assert blocks.where("parent_path is not null").join(up, [*key, "block_list", "parent_path"], "left_anti").isEmpty()
    assert lines.join(blocks, [*key, "block_list", "block_path"], "left_anti").isEmpty()
    assert spans.join(lines, [*key, "block_list", "block_path", "line_no"], "left_anti").isEmpty()


def test_levels(spark):
    record = {"pages": [{"para_blocks": [{"lines": [{"spans": [SPAN, SPAN]}, {}]}, None, {"lines": []}]}, {}]}
    levels = {".".join(c.path): (c.rep, c.dfn) for _, c in shred([record], PARSED_PAGES)}
    assert levels["pages.para_blocks"] == ([0, 2, 2, 1], [4, 3, 4, 2])
    assert levels["pages.para_blocks.lines.spans"] == ([0, 4, 3, 2, 2, 1], [8, 8, 6, 3, 4, 2])
    df = spark.createDataFrame([(1, json.dumps({"pdf_info": record["pages"]}))], "rec_id long, payload string")
    assert {r.path: (r.rep, r.dfn) for r in level_columns(df).collect()} == levels
