"""Personal data beyond words with a digit."""

from tickwarden.llm import pii


def spans(spark, rows):
    return {r["doc_id"]: r["spans"] for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_addresses_without_digits_and_groups_of_digits_are_discovered(spark):
    rows = [(i, f"Contact phone +1 (555) 123-45{i + 10} today") for i in range(60)]
    rows += [(100 + i, f"write mail jane{chr(97 + i % 26)}{i}@example.org soon") for i in range(60)]
    rows += [(200, "Contact phone 555 010 0042 today"), (201, "page 555 010 0042 of"), (202, "Contact phone: 12 of 555 010 0042"),
             (203, "write mail bob(at)example.org soon"), (204, "write mail Bob[AT]example.org, soon"), (205, "page bob(at)example.org of"),
             (206, "Contact phone 555 010 0042x today"), (207, "Contact phone 555123 4567890 today")]
    got = spans(spark, rows)
    assert got[200] == "phone:14:26" and got[203] == "email:11:29" and got[204] == "email:11:29"
    assert got[201] == got[202] == got[205] == ""
    assert got[206] == "phone:14:21" and got[207] == "phone:14:28"
    assert got[0] == "phone:14:31" and got[100] == "email:11:29"


def test_a_long_word_is_a_context_of_its_own(spark):
    near, other = "x" * 100, "y" + "x" * 99
    rows = [(i, f"{near} +1 (555) 123-45{i + 10}") for i in range(60)] + [(100, f"{near} 555-010-0042"), (101, f"{other} 555-010-0042")]
    got = spans(spark, rows)
    assert got[100] == "phone:101:113" and got[101] == ""


def test_groups_in_a_long_table_of_numbers(spark):
    text = " ".join(str(i * 7919) for i in range(60_000)) + " end " + " ".join(f"{i} {i + 1} x" for i in range(20_000))
    row = pii.personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["n_found"] == 0
