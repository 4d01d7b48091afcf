"""License scans against a plain version with dense features, forms of notices, and linear time."""

import random
import re
import time

import numpy as np
import pytest
from conftest import SF_SMALL

from zonekit.llm import licenses as lic


@pytest.fixture(scope="module")
def model(spark):
    return lic.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))


def dense(model, words):
    """Probabilities of one paragraph, from counts written out."""
    v = model.vocabulary
    x = np.zeros(v.features)
    codes = [v.word.get(w, 0) for w in words]
    for c in codes:
        if c > 1:
            x[c] += 1
    for a, b in zip(codes, codes[1:]):
        f = v.pair[a * v.size + b]
        if f >= 0:
            x[f] += 1
    z = (x / max(1, len(words)) ** 0.5 @ model.weights + model.bias) / model.temperature
    e = np.exp(z - z.max())
    return e / e.sum(), {int(v.pair[a * v.size + b]) for a, b in zip(codes, codes[1:])} - {-1}


def plain(text, model):
    """{(family, confirmed)} of all lines and runs of lines, in windows, without any shortcut."""
    lines = [re.findall("[a-z0-9]+", x) for x in text.lower().split("\n")]
    runs, now = [], []
    for x in [*lines, []]:
        if x:
            now.append(x)
        elif now:
            runs.append([w for y in now for w in y] if len(now) > 1 else [])
            now = []

    def told(words):
        out = set()
        starts = [0] if len(words) <= lic.WINDOW else range(0, len(words) - lic.WINDOW + lic.WINDOW // 2, lic.WINDOW // 2)
        for a in starts:
            p, mine = dense(model, words[a:a + lic.WINDOW])
            best = 1 + int(p[1:].argmax())
            if mine and p[best] >= model.least:
                family = lic.FAMILIES[best]
                if max(len(mine & t) / len(t) for t, (f, _) in zip(model.vocabulary.templates, lic.TEMPLATES) if f == family) >= lic.CONTAINED:
                    out.add(family)
        return out
    return set().union(*[told(x) for x in lines if x], *[told(x) for x in runs if x])


def made(seed):
    r = random.Random(seed)
    words = ["the", "of", "and", "license", "version", "this", "is", "a", "public", "software", "any", "person", "blue", "tree", "free"]
    parts = []
    for _ in range(r.randint(1, 12)):
        kind = r.random()
        if kind < 0.4:
            words_of = r.choice(lic.TEMPLATES)[1].split()
            cut = r.choice([len(words_of), 7])
            parts.append("\n".join(" ".join(words_of[i:i + cut]) for i in range(0, len(words_of), cut)))
        else:
            parts.append(" ".join(r.choice(words) for _ in range(r.choice([3, 20, 300]))))
    return r.choice(["\n", "\n\n"]).join(parts)


def test_against_dense_features(model):
    texts = [made(i) for i in range(60)]
    got = lic.scan_texts(texts, model)
    assert [{f["family"] for f in found if f["confirmed"]} for _, found in got] == [plain(t, model) for t in texts]
    assert [n for n, _ in got] == [sum(bool(re.search("[a-z0-9]", x)) for x in t.lower().split("\n")) for t in texts]
    assert got == [lic.scan_texts([t], model)[0] for t in texts]  # texts of a pass don't touch each other


@pytest.mark.parametrize("text, family", [
    ("// SPDX-License-Identifier: MIT", "MIT"), ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("/* SPDX-License-Identifier: GPL-2.0-only */", "GPL-2.0"),
    ("MIT License\n\nCopyright (c) 2020 Someone", "MIT"), ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007", "GPL-3.0"),
    ("BSD 3-Clause License\n\nCopyright (c) 2019", "BSD"), ("Mozilla Public License Version 2.0", "MPL-2.0"), ("CC0 1.0 Universal", "CC0"),
    ("x = 1\n# Unless required by applicable law or agreed to in writing, software\n# distributed under the License is distributed on an \"AS IS\" BASIS,\n"
     "# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", "Apache-2.0")])
def test_forms(model, text, family):
    assert family in {f["family"] for _, found in lic.scan_texts([text], model) for f in found if f["confirmed"]}


def test_other_uses_of_the_words(model):
    for text in [*lic.OTHER, "He lost his driving license in the public library.", "the version of the general who was free", "of the " * 300]:
        assert not any(f["confirmed"] for f in lic.scan_texts([text], model)[0][1]), text


def test_linear(model):
    notice = "Licensed under the Apache License, Version 2.0.\n"
    for text in (notice * 40_000, notice.strip().replace("\n", " ") * 40_000, "of the " * 280_000, "Released under\nthe MIT License.\n" * 60_000, "a\n" * 900_000):
        assert len(text) > 1_500_000
        start = time.process_time()
        lic.scan_texts([text], model)
        assert time.process_time() - start < 10, text[:40]
    assert len(lic.scan_texts([notice * 1000], model)[0][1]) == 1000


def test_sample_is_bounded(spark):
    from zonekit.llm.common import sampled
    df = spark.range(5000).selectExpr("repeat(concat('w', id, ' '), 3000) as text")
    got = sampled(df, "text", 50)
    assert len(got) == 50 and all(len(t) == 4000 for t in got) and got == sampled(df.repartition(3), "text", 50)
    assert sampled(df.limit(0), "text", 50) == [] and len(sampled(df.limit(10), "text", 50)) == 10
