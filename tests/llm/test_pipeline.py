"""The corpus pipeline against its parts' brute force, and the entry file
without the training-data folders."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from conftest_llm import SCHEMA, UPPER, llm, make_rows, prose, words  # noqa: F401
from test_dedup import brute_components
from test_text_rules import BASE, brute_containment, brute_statistics

ROOT = Path(corpus_pipeline.__file__).parent


def _corpus():
    import random

    rng = random.Random(1)
    rows = make_rows(3) + [(500 + i, prose(rng, 120).capitalize() + ".", "en", "s1", 0) for i in range(230)]
    rows += [(800 + i, " ".join(w + "###" for w in prose(rng, 80).split()), "en", "s1", 0) for i in range(12)]
    items = [(0, prose(rng, 35)), (1, prose(rng, 50))]
    rows += [(900 + i, f"{prose(rng, 70)} {items[i % 2][1]} {prose(rng, 20)}", "en", "s2", 0) for i in range(6)]
    rows += [(950 + i, f"{prose(rng, 60)} password=abcdef{i}99 {prose(rng, 20)}", "en", None, 0) for i in range(6)]
    return [(*r[:4], len(r[1] or "")) for r in rows], items


def test_pipeline_equals_brute_force(llm, tmp_path):
    rows, items = _corpus()
    llm.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    llm.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = llm.read.parquet(f"{tmp_path}/documents.parquet"), rows
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(llm, docs, str(tmp_path))
        if i < 4:
            assert got.columns == docs.columns, name
        got.write.parquet(f"{tmp_path}/{name}")
        docs = llm.read.parquet(f"{tmp_path}/{name}")
        have = {r["doc_id"]: r for r in docs.collect()}
        if name == "quality_rules":
            sound = {r[0] for r in kept if (s := brute_statistics(r[1]))[0] >= 50 and 100 * s[4] <= 50 * s[0]}
            assert have.keys() <= sound and not have.keys() & set(range(800, 812))
            assert {r[0] for r in kept if r[0] >= 500 and not 800 <= r[0] < 812} <= have.keys()  # clean ones stay
            kept = [r for r in kept if r[0] in have]
        elif name == "jaccard_join":
            firsts = {c for *_, c in brute_components(kept)}
            assert have.keys() == firsts < {r[0] for r in kept}
            kept = [r for r in kept if r[0] in firsts]
        elif name == "decontamination":
            gone = {d for d, *_ in brute_containment(kept, items)}
            assert gone and have.keys() == {r[0] for r in kept} - gone
            kept = [r for r in kept if r[0] not in gone]
        elif name == "secret_scan":
            assert have.keys() == {r[0] for r in kept}
            for d, text, *_ in kept:
                secret = any(len(m.group(g)) >= n for _, p, g, n in BASE for m in p.finditer(text))
                assert (have[d]["text"] != text) == secret and have[d]["n_chars"] == len(have[d]["text"])
            kept = [(d, have[d]["text"], lang, source, n) for d, _, lang, source, n in kept]
        else:
            size = {r[0]: len(words(r[1])) for r in kept}
            assert all(r["size"] == size[d] and 0 < r["taken"] <= 2 * r["size"] for d, r in have.items())
            for source in {r[3] for r in kept}:
                own = [r for r in have.values() if r["source"] == source]
                assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(1, 0.02 * own[0]["target"])
    run = {(r["doc_id"], r["taken"]) for r in corpus_pipeline.run(llm, str(tmp_path)).collect()}
    assert run == {(d, r["taken"]) for d, r in have.items()}


def test_near_copies_of_five_word_shingles_go(llm):
    """Copies with three to six scattered edits in 200 words: with four, five-word
    shingles are at 0.81 and three-word ones at 0.89."""
    rows = make_rows(3)
    for edits in (3, 4, 5, 6):
        base = [f"w{edits}x{i}" for i in range(200)]
        copy = ["changed" if i % 30 == 15 and i // 30 < edits else w for i, w in enumerate(base)]
        rows += [(1000 + edits, " ".join(base), "en", "s1", 0), (2000 + edits, " ".join(copy), "en", "s1", 0)]
    sets = []
    for r in rows:
        w = [x.translate(UPPER) for x in words(r[1])]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 80 * len(a | b):
                label = [label[j] if x == label[i] else x for x in label]
    want = {min(rows[j][0] for j in range(len(rows)) if label[j] == x) for x in set(label)}
    got = corpus_pipeline.jaccard_join(llm, llm.createDataFrame(rows, SCHEMA), "")
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(want)
    assert not want & {2003, 2004} and want >= {2005, 2006}


def test_entry_imports_without_the_training_data_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q)); assert 'top_times_raw' in q and 'pipeline' not in q and not any(k.startswith('op') for k in q)"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert done.returncode == 0, done.stderr
    assert "stationflow.llm" not in "".join(p.read_text() for p in (copy / "stationflow").rglob("*.py"))
