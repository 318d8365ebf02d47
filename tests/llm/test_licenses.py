import re

from pyspark.sql import functions as F

from millrace.llm import licenses

TEXTS = {
    1: "Licensed under the MIT License. See under the MIT license",
    2: "This work is licensed under the GNU General Public License, version 3.",
    3: "Apache License, Version 2.0 and CC-BY-NC 4.0; SPDX-License-Identifier: BSD-3-Clause",
    4: "Das ist mit einem Wort gesagt",
    5: None,
    6: "",
    7: "cc by nc " * 3_000,
    8: "cc by nc sa",
}


def _scan(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")
    return {r["doc_id"]: r for r in licenses.scan(df).collect()}


def test_base_places_and_labels(spark):
    found = _scan(spark)
    assert [x["start"] for x in found[1]["base"]] == [1, 6]
    label = lambda i: {x["label"] for x in found[i]["detections"]}
    assert label(1) == {"mit"}
    assert label(2) == {"gpl-3"}
    assert label(3) >= {"apache-2", "cc-by-nc", "bsd-3"}
    assert label(4) == label(5) == label(6) == set()
    assert (found[5]["n_words"], found[5]["base"]) == (0, [])
    assert len(found[7]["base"]) == 3_000
    # The base phrase stays beside the longer name around it.
    assert label(8) == {"cc-by-nc", "cc-by-nc-sa"}


def test_no_detection_lies_in_another(spark):
    for row in _scan(spark).values():
        free = [(x["start"], x["end"]) for x in row["detections"] if not x["base"]]
        assert len(set(free)) == len(free)
        assert not any(a != b and b[0] <= a[0] and a[1] <= b[1] for a in free[:50] for b in free[:50])


def test_rules():
    rules = licenses.rules()
    assert len(rules) > 200
    assert all(re.compile(r["pattern"]) and r["keywords"] for r in rules)
    assert [r["label"] for r in rules if r["base"]] == list(licenses.BASE.values())


def test_clashing_names_and_empty_table(spark):
    df = spark.createDataFrame([(1, "under the mit license", "kept")], "doc_id long, text string, words string")
    assert licenses.scan(df).first()["words"] == "kept"
    assert licenses.scan(df.limit(0)).collect() == []


def _samples(parsed, longest=2):
    """All strings of a parsed pattern; a repeat is taken its fewest and most times, ``longest`` times at most."""
    found = [""]
    for op, value in parsed:
        op = str(op)
        if op == "LITERAL":
            each = [chr(value)]
        elif op == "IN":
            each = [c for kind, x in value for c in ([chr(x)] if str(kind) == "LITERAL" else map(chr, range(x[0], x[1] + 1)))]
        elif op == "SUBPATTERN":
            each = _samples(value[-1], longest)
        elif op == "BRANCH":
            each = [x for branch in value[1] for x in _samples(branch, longest)]
        elif op == "MAX_REPEAT":
            once = _samples(value[2], longest)
            each = [x * n for n in {value[0], min(value[1], longest)} for x in once]
        else:
            assert op in ("ASSERT", "ASSERT_NOT")
            each = [""]
        found = [a + b for a in found for b in each]
    return list(dict.fromkeys(found))


def _few(found, n=5):
    return found[:: -(-len(found) // n)]


def test_every_alternative_holds_a_keyword():
    """What a pattern matches is never hidden from it by its keywords."""
    for label, (keywords, name, short) in licenses.FAMILIES.items():
        for pattern in (name, short):
            for text in _samples(re._parser.parse(pattern)):
                assert re.fullmatch(pattern, text)
                assert set(keywords.split()) & set(text.split()), (label, text)
    for rule in licenses.rules():
        if rule["base"]:
            assert any(set(rule["keywords"]) & set(x.split()) for x in _samples(re._parser.parse(rule["pattern"])))


def test_gated_scan_equals_ungated(spark, monkeypatch):
    texts = [f"licensed under the {x} in full" for _, name, _ in licenses.FAMILIES.values() for x in _few(_samples(re._parser.parse(name)))]
    texts += [f"license {x} in full" for _, _, short in licenses.FAMILIES.values() for x in _few(_samples(re._parser.parse(short)))]
    texts += [
        "Licensed under the Common Development and Distribution License",
        "licensed under the Apache2 license",
        "released under the Open Database License",
        "license: MS-PL",
        "spdx-license-identifier: llama3",
        "distributed under the GPLv 2",
        "published under CC Zero",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    read = lambda: {r["doc_id"]: r["detections"] for r in licenses.scan(df).collect()}
    gated = read()
    assert all(gated.values())
    table = licenses.rules()
    every = sorted({k for r in table for k in r["keywords"]} | {w for t in texts for w in re.findall("[a-z0-9]+", t.lower())})
    monkeypatch.setattr(licenses, "rules", lambda: [r | {"keywords": every} for r in table])
    assert gated == read()


def _opens(rule, text):
    words = set(text.split())
    return any(k in words and (k not in licenses.COMPANIONS or words & set(licenses.COMPANIONS[k].split())) for k in rule["keywords"])


def test_everyday_keywords_stand_beside_their_companions():
    """Whatever a rule matches opens it, everyday words included."""
    for rule in licenses.rules():
        if not rule["base"]:
            tree = re._parser.parse(rule["pattern"][len("(?<= )(?:") : -len(")(?= )")].replace("[^ ]+", "any"))
            for text in _few(_samples(tree), 40):
                assert _opens(rule, text), (rule["label"], text)


def test_openings_of_license_texts(spark):
    texts = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")",
        "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that",
        "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that",
        "bsd-3": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
        "boost": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation",
        "apache-2": "You may not use this file except in compliance with the License.",
        "gpl-3": "GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "gpl": "This program is free software: you can redistribute it and/or modify it",
        "lgpl": "This library is free software; you can redistribute it and/or modify it",
        "unlicense": "This is free and unencumbered software released into the public domain.",
        "php": "This product includes PHP software, freely available from the site",
        "": "The server software of our business is universal, common and creative: a python database.",
    }
    df = spark.createDataFrame([(i, f"We say. {t} And more.") for i, t in enumerate(texts.values())], "doc_id long, text string")
    found = {r["doc_id"]: r["labels"] for r in licenses.scan(df).select("doc_id", licenses.labels(F.col("detections")).alias("labels")).collect()}
    assert [found[i] for i in range(len(texts))] == list(texts)
