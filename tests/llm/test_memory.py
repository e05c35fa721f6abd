from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from tillflow.llm import decontaminate, jaccard

ROOT = Path(__file__).resolve().parents[2]

HELD = """
from pathlib import Path
from tillflow.llm.memory import lean

def held():
    return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 1e6

pins = []

def task(batches):
    texts = []
    for batch in batches:
        texts += [bytes(600) for _ in range(100_000)]
        pins.append(bytes(600))  # lies above what is freed
        yield batch

before = held()
assert list(lean(task)([1, 2])) == [1, 2]
print(held() - before)
"""


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_task_gives_back_what_it_has_freed():
    said = subprocess.run([sys.executable, "-c", HELD], cwd=ROOT, capture_output=True, text=True, check=True, timeout=120)
    assert float(said.stdout) < 30  # of about 130 MB


def test_sets_are_made_in_a_stage_of_their_own(spark):
    """Filter and sets in one stage would take two Python workers a task, however few rows there are."""
    docs = [(i, i, " ".join(f"w{i + k}" for k in range(9))) for i in range(6)]
    rows = spark.createDataFrame(docs, "id bigint, tag bigint, text string")
    reps = spark.createDataFrame([(10 + i, i, i) for i in range(0, 6, 2)], "class bigint, id bigint, tag bigint")
    found = jaccard.sets_of(rows, reps, 5)
    assert sorted((r["class"], len(r["own"])) for r in found.collect()) == [(10, 40), (12, 40), (14, 40)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "BroadcastHashJoin" not in plan


def test_leaks_are_found_by_tasks_that_remember_few_words(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "WORDS", 7)
    words = [f"w{k}" for k in range(40)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[::-1])), (3, " ".join(words[5:25]))], "doc_id bigint, text string")
    items = spark.createDataFrame([(9, " ".join(words[6:24]))], "item_id bigint, text string")
    assert [r["doc_id"] for r in decontaminate.without_leaks(docs, items).collect()] == [2]
