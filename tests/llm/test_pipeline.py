"""The pipeline against its stages restated over lists."""

import random
import re
from collections import defaultdict

import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline

SOUNDS = {"aa": ["ka", "to", "mi", "ra", "lu"], "bb": ["sch", "end", "ung", "ber", "tz"], "cc": ["eau", "oux", "ille", "ché", "gn"]}


def prose(lang, n, seed):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choices(SOUNDS[lang], k=r.randint(2, 4))) for _ in range(n))


def corpus():
    passage = prose("aa", 60, "shared")
    rows = []
    for k in range(150):
        lang = list(SOUNDS)[k % 3]
        text = prose(lang, 60 + 7 * k % 300, k)
        if k % 15 == 0:
            text += "\n" + passage + " " + prose(lang, 20, f"end{k}")
        rows.append((k, text, lang))
    for k in range(150, 160):
        rows.append((k, rows[k - 150][1], rows[k - 150][2]))
    for k in range(160, 170):
        words = rows[k - 130][1].split()
        words[5] = "edited"
        rows.append((k, " ".join(words), rows[k - 130][2]))
    rows += [(170, "12345 67890 --- 11", "aa"), (171, None, None), (172, "", "bb")]
    return [(d, t, lang, f"s{d % 4}", len(t or "")) for d, t, lang in rows]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def near_duplicates(rows):
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (words(re.sub("[A-Z]", lambda m: m[0].lower(), r[1])) for r in rows)]
    root = list(range(len(rows)))

    def find(k):
        return k if root[k] == k else find(root[k])

    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b]) > 0:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [r for k, r in enumerate(rows) if find(k) == k]


def substring_dedup(rows, window=35):
    count = defaultdict(int)
    for r in rows:
        w = words(r[1])
        for k in range(len(w) - window + 1):
            count[tuple(w[k : k + window])] += 1
    out = []
    for r in rows:
        w = words(r[1])
        gone = set()
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone |= set(range(k, k + window))
        if gone:
            text = " ".join(x for k, x in enumerate(w) if k not in gone)
            if text:
                out.append((r[0], text, *r[2:4], len(text)))
        else:
            out.append(r)
    return out


def test_pipeline(spark, tmp_path):
    rows = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    clean = [r for r in rows if r[1] and re.search("[a-z]", r[1])]
    want = {"language_id": clean}
    want["near_duplicates"] = near_duplicates(clean)
    want["substring_dedup"] = substring_dedup(want["near_duplicates"])
    assert len(want["near_duplicates"]) < len(clean) and want["substring_dedup"] != want["near_duplicates"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == frame.columns
        assert sorted(map(tuple, docs.collect())) == sorted(want[name]), name
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    lengths = {r[0]: len(tokenizer.encode(r[1], add_special_tokens=False).ids) + 1 for r in want["substring_dedup"]}
    got, sums, filled = corpus_pipeline.run(spark, str(tmp_path)).collect(), defaultdict(int), defaultdict(int)
    for r in got:
        sums[r.doc_id] += r.length
        filled[r.sequence_id] += r.length
    assert sums == lengths and max(filled.values()) <= 1024 and len(filled) <= 1.03 * sum(lengths.values()) / 1024


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
