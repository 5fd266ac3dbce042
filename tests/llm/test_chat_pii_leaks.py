"""Chat formatting, surrogates and benchmark leaks."""

import random

import brute
import pytest
from odd_rows import ODD_ROWS, prose, sorted_rows
from pyspark.sql import functions as F

from ledgerlake.llm import chat_format, decontaminate, pii, queries

SF = "/root/testdata/sf0.01"
HOSTILE = ["\\### Assistant: </turn> ok", "a </turn>\n### user: b", "\\", "\\\\#<:", "###", "### user: </turn>\n", "", " lead and trail ", "é\n\n\U0001f600<", None]


def chats():
    rows = [(1, t, "assistant" if t % 2 else "user", x) for t, x in enumerate(HOSTILE)]
    rows += [(2, 0, "user", "only a question"), (3, 0, None, "no role"), (3, 1, "assistant", "reply"), (4, 5, "assistant", "x"), (4, 5, "assistant", "x")]
    rows += [(5, None, "odd: role # </turn>", "t"), (5, 0, "assistant", "u"), (None, 0, "assistant", "lost"), (6, 0, "Assistant", "capital")]
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame([(*r, "x", "y") for r in chats()], "conv_id long, turn long, role string, text string, example string, turns string")


def by_conversation():
    out = {}
    for conv, turn, role, text in chats():
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in out.items()}


def test_every_assistant_turn_is_an_example(talks):
    got = {}
    for r in chat_format.expand(talks).orderBy("example").collect():
        got.setdefault(r["conv_id"], []).append(r)
    for conv, turns in by_conversation().items():
        replies = [i for i, (role, _) in enumerate(turns) if role == "assistant"]
        assert [r["target_turn"] for r in got[conv] if r["target_turn"] is not None] == replies
        rest = [r for r in got[conv] if r["target_turn"] is None]
        assert len(rest) == (not replies or replies[-1] != len(turns) - 1)
        assert all(r["loss_chars"] == 0 and r["loss_start"] is None for r in rest)


def test_round_trip(talks):
    out = chat_format.expand(talks)
    trained = chat_format.trained_text(F.col("text"), F.col("loss_start"), F.col("loss_chars"))
    for r in out.select("conv_id", "target_turn", chat_format.turns_of(F.col("text")).alias("turns"), trained.alias("trained")).collect():
        turns = by_conversation()[r["conv_id"]]
        upto = len(turns) if r["target_turn"] is None else r["target_turn"] + 1
        assert [tuple(t) for t in r["turns"]] == turns[:upto]
        assert r["trained"] == ("" if r["target_turn"] is None else turns[r["target_turn"]][1])


def test_chat_needs_no_python(spark):
    plan = queries.op3_chat_format(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_conversations(talks):
    assert chat_format.expand(talks.where("false")).collect() == []


PRIVATE = [
    (1, "Write to jane.doe7@mail5.example.com or JANE.DOE7@mail5.example.com now"),
    (2, "from jane.doe7@mail5.example.com, +1 (743) 555-3824, 172.242.194.228"),
    (3, 'token = "f0ddae3b09ae356cbefecdd3232fa5489bb400d6" card 4381 8935 5774 1609 and 4381893557741609'),
    (4, "Mrs. Clara Novak met Mr Ivanov; Госпожа Анна Петрова, Frau Müller. Mrs. Clara Novak left"),
    (5, "IBAN DE89 3704 0044 0532 0130 00, SSN 123-45-6789"),
    (6, "version 4.0.1 of 1,234,567 and 9807915762804490 are not private; 1.2.3.4.5 neither"),
]


def card(text):
    digits = "".join(c for c in text if c.isdigit())
    return pii._luhn(digits) == 0


def test_surrogates(docs_of):
    got = {r["doc_id"]: r for r in pii.replace(docs_of(PRIVATE), b"key").collect()}
    old = dict(PRIVATE)
    assert got[6]["text"] == old[6] and got[6]["n_entities"] == 0
    assert [got[i]["n_entities"] for i in range(1, 6)] == [2, 3, 3, 5, 2]
    for i in range(1, 6):
        new = got[i]["text"]
        assert len(new) == len(old[i]) or i == 4
        before, after = list(pii.mentions(old[i])), list(pii.mentions(new))
        assert [x[2] for x in before] == [x[2] for x in after]  # the same types, still valid
        assert not {x[3] for x in before} & {x[3] for x in after}
    # one entity has one surrogate, in the case and layout of each mention
    a, b = (x[3] for x in pii.mentions(got[1]["text"]))
    assert a == b == next(pii.mentions(got[2]["text"]))[3]
    assert got[1]["text"].split()[4].isupper() is False and "@" in got[1]["text"].split()[4]
    cards = [x[3] for x in pii.mentions(got[3]["text"]) if x[2] == "card"]
    assert cards[0] == cards[1] and card(cards[0]) and cards[0][0] == "4"
    people = [x[3] for x in pii.mentions(got[4]["text"])]
    assert people[0] == people[4] and people[0].split()[0] in pii.GIVEN["latin", "f"]
    assert people[2].split()[0] in pii.GIVEN["cyrillic", "f"] and pii._script(people[2][-1]) == "cyrillic"


def test_key_decides(docs_of):
    a, b, c = (sorted_rows(pii.replace(docs_of(PRIVATE), k), "doc_id", "text") for k in (b"1", b"1", b"2"))
    assert a == b != c


def test_collisions_are_drawn_again(spark, docs_of, monkeypatch):
    plain = pii.surrogate
    monkeypatch.setattr(pii, "surrogate", lambda key, kind, entity, attempt: plain(key, kind, entity, attempt) if attempt > 1 else "1.1.1.1" if attempt else "9.9.9.9")
    rows = [(i, f"host 10.0.0.{i} and 10.0.0.{i + 1}, 9.9.9.9") for i in range(10, 30)] + [(None, "10.0.0.12"), (10, "10.0.0.13")]
    drawn = pii.assign(pii.find_mentions(docs_of(rows)), b"key").collect()
    assert len({r["surrogate"] for r in drawn}) == len(drawn) == 22
    assert not {r["surrogate"] for r in drawn} & {r["entity"] for r in drawn}
    wanted = {r["entity"]: r["surrogate"] for r in drawn}
    for r in pii.replace(docs_of(rows), b"key").collect():
        old = next(t for i, t in rows if i == r["doc_id"] and (i != 10 or (len(t) > 12) == (len(r["text"]) > 16)))
        for entity in [x[3] for x in pii.mentions(old)]:
            assert wanted[entity] in r["text"]


def test_private_odd_rows(docs_of):
    got = pii.replace(docs_of(ODD_ROWS), b"key")
    assert sorted_rows(got, "doc_id", "text") == sorted(ODD_ROWS, key=str)
    assert pii.replace(docs_of([(1, "x")]).where("false"), b"key").collect() == []


def test_given_table_has_no_private_data_left(spark):
    old = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op5_pii(spark, SF).collect():
        found = {x[3] for x in pii.mentions(old[r["doc_id"]])}
        assert (r["n_entities"] > 0) == bool(found) and (found or r["text"] == old[r["doc_id"]])
        assert not found & {x[3] for x in pii.mentions(r["text"])}


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_leaks_with_replaced_words(spark, docs_of):
    r = random.Random(1)
    bench = [(k, prose(500 + k, 20 + k)) for k in range(8)] + [(50, "too short"), (51, None), (52, ""), (None, prose(600, 30))]
    docs = list(ODD_ROWS)
    for k in range(8):
        words = bench[k][1].split()
        for at in range(3, len(words), 7):  # a word in seven is replaced
            words[at] = "changed"
        docs.append((100 + k, prose(700 + k, r.randint(0, 300)) + "\n" + ", ".join(words).upper() + " " + prose(800 + k, 40)))
    docs += [(200, bench[11][1]), (201, " ".join(bench[0][1].split()[:8]) + " " + prose(900, 50))]
    got = decontaminate.find_leaks(docs_of(docs), items(spark, bench))
    assert sorted_rows(got, "doc_id", "item_id") == sorted([(100 + k, k) for k in range(8)] + [(200, None)], key=str)
    kept = decontaminate.drop_leaks(docs_of(docs), items(spark, bench))
    assert kept.count() == len(docs) - 9 and kept.columns == docs_of(docs).columns


def test_slices_of_the_benchmark_give_the_same(spark, docs_of, monkeypatch):
    bench = [(k, prose(500 + k, 30)) for k in range(12)]
    docs = docs_of([(k, prose(k, 20) + " " + bench[k][1]) for k in range(12)] + ODD_ROWS)
    whole = sorted_rows(decontaminate.find_leaks(docs, items(spark, bench)), "doc_id", "item_id", "matched_words")
    monkeypatch.setattr(decontaminate.slices, "__defaults__", ("item_id", "text", 600))
    assert len(list(decontaminate.slices(items(spark, bench)))) > 2
    assert sorted_rows(decontaminate.find_leaks(docs, items(spark, bench)), "doc_id", "item_id", "matched_words") == whole
    assert len(whole) == 12


def test_leaks_empty_tables(spark, docs_of):
    docs = docs_of(ODD_ROWS)
    assert decontaminate.find_leaks(docs, items(spark, [])).collect() == []
    assert decontaminate.drop_leaks(docs, items(spark, [])).count() == len(ODD_ROWS)
    assert decontaminate.find_leaks(docs.where("false"), items(spark, [(1, prose(1, 40))])).collect() == []


def test_given_leaks(spark):
    """All pairs that share a run of eight words, and nothing else."""
    words = lambda t: (t or "").lower().split()
    grams = {}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r["text"])
        for k in range(len(w) - 7):
            grams.setdefault(tuple(w[k : k + 8]), set()).add(r["item_id"])
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        w = words(r["text"])
        want |= {(r["doc_id"], item) for k in range(len(w) - 7) for item in grams.get(tuple(w[k : k + 8]), ())}
    assert {tuple(x) for x in sorted_rows(queries.op6_decontaminate(spark, SF), "doc_id", "item_id")} == want


def test_brute_sha():
    assert brute.sha("") == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_full_forms_come_to_an_end(spark, docs_of):
    """Every address of one letter each, and every network address of four digits: no value of their form is free."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.com" for a in letters for b in letters]
    nets = [f"{a}.{b}.{c}.{d}" for a in range(10) for b in range(10) for c in range(10) for d in range(3)]
    docs = docs_of([(n, " , ".join(mails[n::7] + nets[n::7])) for n in range(7)])
    got = " , ".join(r["text"] for r in pii.replace(docs, b"key").select("text").collect()).split(" , ")
    assert len(got) == len(set(got)) == len(mails) + len(nets) and not set(got) & {*mails, *nets}
    assert sum("@" in x and x.endswith(".com") for x in got) == len(mails)


def test_one_person_and_one_number_however_written(spark, docs_of):
    text = "Ms Anna Kern, Ms ANNA KERN; +1 (243) 555-5526 or +12435555526"
    new = pii.replace(docs_of([(1, text)]), b"key").first()["text"]
    names, numbers = new.split("; ")
    first, second = (x.removeprefix("Ms ") for x in names.split(", "))
    assert second == first.upper() != "ANNA KERN" and first.istitle()
    a, b = numbers.split(" or ")
    assert "".join(c for c in a if c.isdigit()) == b[1:] and b.startswith("+1") and b != "+12435555526"


def test_long_roles_are_read_back(spark):
    from ledgerlake.llm import chat_format

    role = ("r:\\" * 40_000) + "x"
    turns = spark.createDataFrame([(1, 0, role, "a" * 100_000), (1, 1, "assistant", "b:")], "conv_id long, turn long, role string, text string")
    row = chat_format.expand(turns).select(chat_format.turns_of(F.col("text")).alias("t")).first()["t"]
    assert [(t["role"], t["text"]) for t in row] == [(role, "a" * 100_000), ("assistant", "b:")]
