import math
import random
import re

from biblioforge.llm import licenses

KNOWN = licenses.Templates()


def brute(text):
    """(licence, cosine) of a header by whole dense vectors."""
    own = set(re.findall(licenses.TOKEN, text.lower()))
    norm = lambda ts: math.sqrt(sum(KNOWN.idf.get(t, KNOWN.unknown) ** 2 for t in ts))
    best = {}
    for name, _, terms in KNOWN.terms:
        if own:
            c = round(sum(KNOWN.idf[t] ** 2 for t in own & set(terms)) / norm(own) / norm(terms), 6)
            best[name] = max(c, best.get(name, 0))
    c, name = min([(-c, n) for n, c in best.items()], default=(0, None))
    return (name, -c) if -c >= licenses.MIN_COSINE else None


def test_scores_equal_brute_force(spark):
    r = random.Random(1)
    vocabulary = sorted(KNOWN.idf)
    lines = ["Redistribution and use in source and binary forms, with or without", "Permission is hereby granted, free of charge, to any person", "SPDX-License-Identifier: MIT", "the of and to in", "", "GNU GENERAL PUBLIC LICENSE"]
    for _ in range(300):
        _, _, terms = r.choice(KNOWN.terms)
        own = r.sample(terms, r.randint(1, len(terms))) + r.sample(vocabulary, r.randint(0, 4)) + [f"x{r.randrange(99)}" for _ in range(r.randint(0, 6))]
        lines.append(" ".join(own))
    files = spark.createDataFrame([(i, f"d{i}/f.txt", t, "x") for i, t in enumerate(lines)], "file_id long, path string, text string, license string")
    got = {x.file_id: (x.license, x.cosine) if x.origin == "own" else None for x in licenses.scan_licenses(files).collect()}
    assert {i: got[i] for i in got if not (got[i] == brute(lines[i]) or got[i] and abs(got[i][1] - brute(lines[i])[1]) < 2e-6)} == {}
    assert sum(x is not None for x in got.values()) > 50


def test_wrapped_headers_files_and_odd_rows(spark):
    apache = next(t for t in licenses.TEMPLATES["Apache-2.0"] if "governing" in t)
    words = apache.split()
    wrapped = "# code\n\n" + "\n".join("# " + " ".join(words[k : k + 9]) for k in range(0, len(words), 9)) + "\n\nx = 1\n" + "word " * 30_000
    rows = [(1, "p/a.py", wrapped), (1, "p/a.py", wrapped), (2, "p/COPYING", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\n" + "text " * 500), (3, "p/q/b.py", "plain"), (4, None, None), (None, "p/c.py", ""), (5, "r/LICENSE", "\n".join(licenses.TEMPLATES["MIT"][2:]))]
    got = [(x.file_id, x.license, x.origin) for x in licenses.scan_licenses(spark.createDataFrame(rows, "file_id long, path string, text string")).collect()]
    assert sorted(got, key=str) == sorted([(1, "Apache-2.0", "own"), (1, "Apache-2.0", "own"), (2, "GPL-3.0", "own"), (3, "GPL-3.0", "inherited"), (4, None, "none"), (None, "GPL-3.0", "inherited"), (5, "MIT", "own")], key=str)
    assert licenses.scan_licenses(spark.createDataFrame([], "file_id long, path string, text string")).count() == 0
