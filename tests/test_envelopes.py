"""Items of large payloads that many tasks read, against a parser of the whole payload."""

import json
import random

import pytest

from lakeloom.sources import envelopes
from tests.conftest import rows


def value(rng, depth=0):
    kind = rng.random()
    text = "".join(rng.choice(['a', '"', "\\", "}", "{", "]", "[", ",", "é", "\n", ":"]) for _ in range(rng.randrange(7)))
    if kind < 0.45 or depth > 2:
        return rng.choice([text, 1, 2.5, None, True, ""])
    if kind < 0.75:
        return {rng.choice(["k", "drinks", "x}"]) + str(i): value(rng, depth + 1) for i in range(rng.randrange(3))}
    return [value(rng, depth + 1) for _ in range(rng.randrange(3))]


def payload(rng, n):
    items = [
        {"id": i, "name": value(rng, 3), "more": value(rng)} if rng.random() < 0.85 else value(rng) for i in range(n)
    ]
    others = [("meta", value(rng)), ("list", [value(rng) for _ in range(3)]), ("nested", {"drinks": [{"id": -1}]})]
    whole = others[: rng.randrange(4)] + [("drinks", items)] + others[: rng.randrange(4)]
    return dict(whole)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_a_parser_of_the_whole_payload(spark, tmp_path, settings, seed):
    rng = random.Random(seed)
    expected = []
    for i, n in enumerate((120, 30, 1, 0)):
        made = payload(rng, n)
        text = json.dumps(made, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        (tmp_path / f"p{i}.json").write_text(text)
        expected += [(f"p{i}.json", x) for x in made["drinks"] if isinstance(x, dict)]
    (tmp_path / "none.json").write_text('{"drinks": "None Found", "other": [{"id": 1}]}')
    (tmp_path / "null.json").write_text("null")
    (tmp_path / "empty.json").write_text("")
    settings(spark__sql__files__maxPartitionBytes="400", spark__sql__files__openCostInBytes="100")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    found = [(r.file.rsplit("/", 1)[1], json.loads(r["item"])) for r in envelopes.read_items(spark, str(tmp_path), "drinks").collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert len(expected) > 80


def test_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"drinks": [{"id": "1", "n": {"v": "x}"}}, "no", {"id": "2"}]}\n')
    found = envelopes.read_envelope(spark, str(tmp_path), "drinks", "id STRING, n STRUCT<v: STRING>")
    assert rows(found.select("id", "n.v")) == [("1", "x}"), ("2", None)]
