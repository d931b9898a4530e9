"""Which candidates are taken for secrets: bare numbers are not, names of any length are."""

from stepfold.llm import pii
from stepfold.llm.common import table
from tests.llm.test_bare_credentials import BARE
from tests.llm.test_operators import PERSONAL, frame

NUMBERS = ["4539578763621487", "1234567890123456", "00000000000000000000", "12345678901234567890123"]
NAMES = ["db_password", "a_longer_name_than_that_password", "2fa_token", "MY-SERVICE-API_KEY", "x" * 300 + "_secret"]


def rows(spark, texts):
    df = frame(spark, texts)
    return {r["text"]: [s["found"] for s in r["added"]] for r in pii.all_spans(df, "text", pii.train(df, "text")).collect()}


def test_bare_numbers_are_no_secrets(spark):
    texts = [f"order {n} was sent, see {n}." for n in NUMBERS]
    found = rows(spark, texts * 3 + PERSONAL + [f"saw {t} here" for t in BARE] * 3)
    assert all(found[t] == [] for t in texts)
    assert [t for t in BARE[:-1] if found[f"saw {t} here"] != [t]] == []


def test_names_of_any_length(spark):
    texts = [f"login with {n}=b7db7aa4a5fcc78305 now" for n in NAMES]
    found = rows(spark, texts * 3 + PERSONAL)
    assert all(found[t] == [f"{n}=b7db7aa4a5fcc78305"] for t, n in zip(texts, NAMES))


def test_gates_let_every_candidate_through(spark):
    df = table(spark, "/root/testdata/sf0.01", "documents").select("text").unionAll(frame(spark, PERSONAL + BARE + NAMES + NUMBERS).select("text"))
    gate = " OR ".join(pii.GATES).replace("{t}", "text")
    assert df.where(f"text RLIKE {pii._sql(pii.CANDIDATE)}").count() > 20
    assert df.where(f"text RLIKE {pii._sql(pii.CANDIDATE)} AND NOT ({gate})").count() == 0


def test_nothing_but_digits_is_added_on_the_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = pii.with_added(f := pii.candidates(docs, "text").drop("text"), pii.train_on(f)).selectExpr("explode(added) as a").select("a.found")
    assert found.count() > 0 and found.where("found RLIKE '^[0-9]+$'").count() == 0
