"""Rooms of projects against a plain walk."""

from __future__ import annotations

import random
from collections import Counter

from lodestore.sources import rooms


def plain_rooms(paths):
    files = [p for p in ([x for x in (path or "").split("/") if x] for path in paths) if p]
    known = lambda x: rooms.ROOMS.get(x.lower().replace("-", "_"))
    found = {}
    for top in sorted({p[0] for p in files if len(p) > 1} - set(rooms.SKIPPED)):
        own = top.lower().replace("-", "_").replace(" ", "_") if len(top) > 2 and top[0].isalpha() else None
        if name := known(top) or own:
            found.setdefault(name, top)
    for sub in sorted({p[1] for p in files if len(p) > 2 and p[0] not in rooms.SKIPPED} - set(rooms.SKIPPED)):
        if name := known(sub):
            found.setdefault(name, sub)
    if found:
        out = [(n, f"Files from {f}/", [n, f.lower()]) for n, f in found.items()]
        return out + ([] if "general" in found else [("general", "Files that don't fit other rooms", [])])
    counts = Counter()
    for p in files:
        if not set(p[:-1]) & set(rooms.SKIPPED):
            name = p[-1].lower().replace("-", "_").replace(" ", "_")
            counts.update(room for k, room in rooms.ROOMS.items() if k in name)
    best = sorted(((-n, r) for r, n in counts.items() if n >= 2))[:6]
    return [(r, f"Files related to {r}", [r]) for _, r in best] or [("general", "All project files", [])]


def test_rooms_equal_a_plain_walk(spark):
    rng = random.Random(28)
    tops, subs = ["src", "Front-End", "docs", ".git", "a", "Meeting Notes", "9x", "general", "build", "API"], ["tests", "ui", "lib", "node_modules", "HR", "front_end"]
    names = ["readme.md", "test_api.py", "cost-plan.xlsx", "x.txt", "team meeting.md", "config.json", "qa.md", "papers.pdf", "roadmap.md"]
    rows = []
    for k in range(40):
        for _ in range(rng.randrange(1, 12)):
            depth = 0 if k % 3 == 0 else rng.randrange(4)
            parts = ([rng.choice([".git", "a"]) if k % 4 == 1 else rng.choice(tops)] + [rng.choice(subs) for _ in range(3)])[:depth]
            rows.append((f"p{k}" if k else None, "/".join([*parts, rng.choice(names)])))
    rows += [("empty", None), ("empty", ""), ("empty", "/"), ("p1", "src//x.txt"), *[("hot", "docs/a.md")] * 50]
    got = rooms.detect(spark.createDataFrame([(*r, "z") for r in rows], "project string, path string, name string").repartition(3)).collect()
    mine = sorted(((r.project, r["name"], r.description, r.keywords) for r in got), key=str)
    expected = [(p, *room) for p in {p for p, path in rows if (path or "").strip("/")} for room in plain_rooms([x for q, x in rows if q == p])]
    assert mine == sorted(expected, key=str)
    assert {"Files related to testing", "All project files", "Files from Front-End/"} <= {r.description for r in got}
    assert rooms.detect(spark.createDataFrame([], "project string, path string")).count() == 0
