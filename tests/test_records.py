"""Records with line breaks over the borders of file pieces, against a reader of the whole file."""

import csv
import io
import random

import pytest

from lakeloom.sources import records
from tests.conftest import rows

HEADER = ["a", "b", "c"]


def plain(text):
    """Records by Python's reader, its lenient rules for quotes, lines ended by line feeds only."""
    return [r for r in csv.reader(io.StringIO(text, newline="\n"), strict=False)]


def random_field(rng):
    kind = rng.random()
    words = ["x", "yy", "", "5", "é", "\\", "w" * rng.randrange(30)]
    if kind < 0.4:
        return rng.choice(words)
    inside = "".join(rng.choice(["a", ",", "\n", '""', " ", "line\n", "b"]) for _ in range(rng.randrange(8)))
    if kind < 0.95:
        return f'"{inside}"'
    return rng.choice(["mid\"dle", "a\"\"b", "tail\""])  # a quote that opens nothing


def random_file(rng, n, unclosed):
    lines = [",".join(random_field(rng) for _ in range(rng.choice([3, 3, 3, 3, 2, 4]))) for _ in range(n)]
    text = "\n".join(lines) + "\n"
    return text + ('x,"never closed\nmore,"' if unclosed == 1 else 'x,"never\nclosed,y\nz' if unclosed == 2 else "")


@pytest.mark.parametrize("seed, unclosed", [(1, 0), (2, 1), (3, 2), (4, 0)])
def test_equal_to_a_reader_of_the_whole_file(spark, tmp_path, settings, seed, unclosed):
    rng = random.Random(seed)
    texts = [random_file(rng, n, unclosed if i == 0 else 0) for i, n in enumerate((150, 40, 1))]
    for i, text in enumerate(texts):
        (tmp_path / f"f{i}.csv").write_text(text, newline="\n")
    settings(spark__sql__files__maxPartitionBytes="300", spark__sql__files__openCostInBytes="100")
    found = records.read_csv_records(spark, str(tmp_path), HEADER)
    expected = [tuple(r) for text in texts for r in plain(text) if len(r) == 3]
    assert rows(found) == sorted(expected, key=repr)
    assert len(expected) > 50
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
    metrics = records.read_csv_record_metrics(spark, str(tmp_path), HEADER).head()
    assert metrics.row_count - metrics.malformed_rows == len(expected)


def test_files_without_quotes_and_empty_ones(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2,3\r\n4,5,6\n7,8\n")
    (tmp_path / "b.csv").write_text("")
    assert rows(records.read_csv_records(spark, str(tmp_path), HEADER)) == [("1", "2", "3"), ("4", "5", "6")]
