"""Quality rules against the SQL form and a plain count, on odd texts."""

import re

import duckdb
import pyarrow as pa

from tierline.llm import line_quality

BLOCK = "one two three four five six seven eight nine ten\n" * 6



def own(seed):
    letters = "abcdefghijklmnop"
    return " ".join("".join(letters[(seed * 60 + i) // 16**k % 16] for k in range(4)) for i in range(60))


OWN = own(999)
SCHEMA = "doc_id long, text string, source string, hash long, lines string, row int"


def texts():
    odd = [None, "", " \n\t ", "one", OWN, OWN, BLOCK, "a\x0bb\x0cc d\r\n# * <|> &%$\n# * <|> &%$", "x " * 20000, "é😀 ß " * 30, "w" * 50000]
    shared = "licensed under the terms 2.0 of this"
    many = [f"{own(i)}\n  Licensed   under the TERMS {i}.0 of this" for i in range(60)]
    hollow = [f"{shared}\n" * 30 + f"tail{i} " * 3 for i in range(3)]
    return odd + many + hollow


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None if i % 9 == 8 else "src", 1, "x", 2) for i, t in enumerate(rows)], SCHEMA)


def test_equals_the_sql_form(spark):
    documents = pa.Table.from_pylist([{"doc_id": i, "text": t, "source": None if i % 9 == 8 else "src"} for i, t in enumerate(texts())])
    connection = duckdb.connect()
    connection.register("documents", documents)
    result = connection.execute(line_quality.ORACLE_SQL)
    names = [c[0] for c in result.description]
    wanted = sorted(result.fetchall(), key=repr)
    done = line_quality.judge(frame(spark, texts()).repartition(3))
    assert sorted(done.columns) == sorted(names)
    assert sorted((tuple(r) for r in done.select(*names).collect()), key=repr) == wanted


def test_counts_by_hand(spark):
    rows = {r.doc_id: r for r in line_quality.judge(frame(spark, texts())).collect()}
    assert len(rows) == len(texts())
    for i, text in enumerate(texts()):
        found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(found[k : k + 3]) for k in range(len(found) - 2)]
        seen, twice = {}, set()
        for k, w in enumerate(windows):
            seen.setdefault(w, []).append(k)
        for places in seen.values():
            if len(places) > 1:
                twice.update(p + d for p in places for d in range(3))
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(found), sum(map(len, found)), len(twice)), i
        assert r.n_dup_lines == len(lines) - len(set(lines)), i
        assert r.n_symbols == sum((text or "").count(c) for c in "#*$%&|<>"), i
        assert r.base_failed == (len(found) < 50 or 100 * len(twice) > 50 * len(found)), i


def test_common_lines_deplete_hollow_documents_only(spark):
    rows = {r.doc_id: r for r in line_quality.judge(frame(spark, texts()), limit=20, min_kept_percent=30).collect()}
    assert rows[4].kept and rows[5].kept
    assert rows[12].kept and rows[12].n_common_words == 7
    assert not rows[6].kept and rows[6].base_failed
    rows = {r.doc_id: r for r in line_quality.judge(frame(spark, [f"{own(500)}\n{own(i)[:30]}" for i in range(40)]), limit=20).collect()}
    assert not rows[0].kept and not rows[0].base_failed and rows[0].n_common_words == 60
    assert rows[8].n_common_words == 0


def test_copies_count_once(spark):
    judged = line_quality.judge(frame(spark, [OWN] * 80), limit=20).collect()
    assert {(r.kept, r.n_common_words) for r in judged} == {(True, 0)}
    assert line_quality.judge(frame(spark, [OWN]).limit(0)).collect() == []
