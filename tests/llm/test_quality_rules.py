"""Base counts against plain Python, line rules, odd texts."""

import random
import re

from pyspark.sql import functions as F

from tally.llm import quality_rules as qr

SCHEMA = "doc_id long, text string, kept string"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def judged(spark, texts):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    return sorted(qr.clean(df).collect(), key=lambda r: r.doc_id)


def test_counts(spark):
    rng = random.Random(4)
    alphabet = ["a", "b", "cc", "é#", "🙂", "|", "&&", "<x>"]
    texts = [rng.choice(["", " "]) + "".join(rng.choice(alphabet) + rng.choice([" ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b"])
                                             for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", "\n\n", " x ", "a b c d e a b c d e", "a a a a a a a", "w " * 30_000, "    x"]
    for t, r in zip(texts, judged(spark, texts)):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(t), t
        n, _, _, _, repeat = counts(t)
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert not (r.base_failed and r.kept)


GOOD = "A clean line of text stands here, and it ends as sentences do."


def test_line_rules(spark):
    bad = ["Home | About | News | Contact | Help", "Buy&&& this### now*** cheap%%% offer$$$ today&&&", "BUY!! NOW!! CHEAP!! OFFER!!",
           "We use cookies to make this site work. Accept cookies.", "one two three four five six seven eight nine ten eleven"]
    fine = [GOOD, "Short title", "Ünlü çizgi: \"quoted end.\"", "This work is licensed under a licence, version 3.",
            "A question mark stands in the middle? Then more words follow it without an end", "A | B is one bar in a longer sentence."]
    for line, r in zip(bad, judged(spark, [GOOD + "\n" + x + "\n\n" + GOOD for x in bad])):
        assert r.cleaned == GOOD + "\n\n" + GOOD, line
    more = "Another good sentence follows the first one here."
    for line, r in zip(fine, judged(spark, [x + "\n" + more for x in fine])):
        assert r.cleaned == line + "\n" + more and r.kept, line


def test_documents_that_lose_too_much_go(spark):
    menu = "Home | About | News | Contact | Help | More | Less | Other | Last | End"
    rows = judged(spark, [menu + "\n" + GOOD, GOOD + "\n" + menu + "\n" + menu.lower(), menu])
    assert [r.kept for r in rows] == [False, False, False]
    assert judged(spark, [GOOD + "\n" + GOOD.upper() + "\n" + "Home | About | News | Help"])[0].kept


def test_filter_on_the_verdict_and_empty_table(spark):
    df = spark.createDataFrame([(1, GOOD + " " + "It says more. " * 2, None), (2, None, None)], SCHEMA)
    assert [r.doc_id for r in qr.clean(df).filter("kept").collect()] == [1]
    assert qr.clean(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    from tally.llm import sharding

    for df in (qr.query(spark, "/root/testdata/sf0.001"), sharding.query(spark, "/root/testdata/sf0.001")):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


def test_columns_with_working_names_stay(spark):
    names = ["_words", "_lines", "_windows", "_sorted", "_with_word", "_JUDGED", "__words"]
    text = "One two three four five six seven eight nine ten eleven words."
    df = spark.createDataFrame([(1, text, *names)], ["doc_id", "text", *names])
    got = qr.clean(df).first()
    assert [got[n] for n in names] == names and got["n_words"] == 12 and got["kept"]
    by_name = qr.clean(df.drop("text").withColumn("_words", F.lit(text)), text="_words").first()
    assert by_name["n_words"] == 12 and by_name["_words"] == text
