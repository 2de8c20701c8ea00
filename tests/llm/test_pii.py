"""Problem 8: unseen texts by hand, held-out generated ones, invariants, edge rows."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from askmill.llm import pii
from askmill.llm.pii_training import examples, fixed_parts, lexicon

P, N, I, E, A = "phone", "person_name", "id_number", "email", "address"

#: Texts that share no sentence with the training: what must be found in each.
UNSEEN = [
    ("The plumber is Ganesh Lokhande.", [(N, "Ganesh Lokhande")]),
    ("Quotation prepared by Ruth Abernathy for the hall.", [(N, "Ruth Abernathy")]),
    ("Lakshmi Venkata Subba Reddy chaired the session.", [(N, "Lakshmi Venkata Subba Reddy")]),
    ("We thank Mr. P. K. Sundaram for his help.", [(N, "P. K. Sundaram")]),
    ("Landlord: Imtiaz Qureshi", [(N, "Imtiaz Qureshi")]),
    ("Best,\nDebjani Sarkar", [(N, "Debjani Sarkar")]),
    ("Yesterday Tobias Lindqvist repaired our roof.", [(N, "Tobias Lindqvist")]),
    ("Dr. Vasudha Rangarajan will see you now.", [(N, "Vasudha Rangarajan")]),
    ("Complaint lodged by Smt. Parvati Bhosale against the shop.", [(N, "Parvati Bhosale")]),
    ("S. Mohanty refused to pay.", [(N, "S. Mohanty")]),
    ("The accused, Harish Chandra Negi, was released.", [(N, "Harish Chandra Negi")]),
    ("Nurse Blessing Okonkwo gave the injection.", [(N, "Blessing Okonkwo")]),
    ("राजेश शर्मा", [(N, "राजेश शर्मा")]),
    ("मेरा नाम सुरेश पाटिल है।", [(N, "सुरेश पाटिल")]),
    ("श्री दिनेश ठाकुर आए थे।", [(N, "दिनेश ठाकुर")]),
    ("please tell kishore bhandari to wait", [(N, "kishore bhandari")]),
    ("Roommate Anjali Deshpande cooked. Anjali also cleaned.", [(N, "Anjali Deshpande"), (N, "Anjali")]),
    ("Winner: Mateo Fernandez\nPrize: 500", [(N, "Mateo Fernandez")]),
    ("Guide Tenzin Norbu led the trek.", [(N, "Tenzin Norbu")]),
    ("To whom it may concern, Zubin Irani worked here.", [(N, "Zubin Irani")]),
    ("Reach the plumber on 98450 11223.", [(P, "98450 11223")]),
    ("Helpline +91 80 4567 8901 is free.", [(P, "+91 80 4567 8901")]),
    ("Ring (022) 2567 8899 after ten.", [(P, "(022) 2567 8899")]),
    ("My number's 9876501234, bye.", [(P, "9876501234")]),
    ("Call 011-23456789 for a taxi.", [(P, "011-23456789")]),
    ("US office: +1 415-555-0132", [(P, "+1 415-555-0132")]),
    ("nine eight seven six five four three two one zero is my number", [(P, "nine eight seven six five four three two one zero")]),
    ("Reception 080.2345.6789", [(P, "080.2345.6789")]),
    ("Mob 09823012345", [(P, "09823012345")]),
    ("फोन ९८७६५०१२३४ पर", [(P, "९८७६५०१२३४")]),
    ("Two lines: 9000011122 and 9000011133.", [(P, "9000011122"), (P, "9000011133")]),
    ("Write: r.menon@fastmail.com", [(E, "r.menon@fastmail.com")]),
    ("Resume to hr-team@blue-sky.co.in today", [(E, "hr-team@blue-sky.co.in")]),
    ("asha.k at gmail dot com works too", [(E, "asha.k at gmail dot com")]),
    ("vikram[at]tiger[dot]org", [(E, "vikram[at]tiger[dot]org")]),
    ("zoe_99 (at) inbox.net", [(E, "zoe_99 (at) inbox.net")]),
    ("SUPPORT@RIVERBANK.ORG", [(E, "SUPPORT@RIVERBANK.ORG")]),
    ("Account tom.w+news@mail.uni-bonn.edu closed.", [(E, "tom.w+news@mail.uni-bonn.edu")]),
    ("Her Aadhaar is 4821 7733 9015.", [(I, "4821 7733 9015")]),
    ("Aadhaar: 482177339015", [(I, "482177339015")]),
    ("PAN ABQPK4411L belongs to him.", [(I, "ABQPK4411L")]),
    ("Voter id XKT3390217 is torn.", [(I, "XKT3390217")]),
    ("Passport K7712093 was stamped.", [(I, "K7712093")]),
    ("uid 4821-7733-9015 checked", [(I, "4821-7733-9015")]),
    ("Driving licence MH1420110062821 expired.", [(I, "MH1420110062821")]),
    ("Lives at 221 Baker Street, London 560001.", [(A, "221 Baker Street, London 560001")]),
    ("Shanti Niwas, Kothrud, Pune 411038", [(A, "Shanti Niwas, Kothrud, Pune 411038")]),
    ("14 MG Extension, Jayanagar, Bengaluru 560011", [(A, "14 MG Extension, Jayanagar, Bengaluru 560011")]),
    ("Deliver to Flat 4B, Orchid Towers, Linking Road, Mumbai 400050.", [(A, "Flat 4B, Orchid Towers, Linking Road, Mumbai 400050")]),
    ("Address: H.No. 7-1-32, Ameerpet, Hyderabad - 500016", [(A, "H.No. 7-1-32, Ameerpet, Hyderabad - 500016")]),
    ("They stay at Door No. 18, Gandhi Nagar, Trichy.", [(A, "Door No. 18, Gandhi Nagar, Trichy")]),
    ("Plot No. 55, Sector 9, Gandhinagar 382009 is sold.", [(A, "Plot No. 55, Sector 9, Gandhinagar 382009")]),
    ("Office: 3rd Floor, 12/4 Residency Road, Bengaluru 560025", [(A, "12/4 Residency Road, Bengaluru 560025")]),
    ("House No. 302, Ashoka Vihar, near City Hospital, Jaipur 302017", [(A, "House No. 302, Ashoka Vihar, near City Hospital, Jaipur 302017")]),
    ("Manish Tandon, 45 Civil Lines, Kanpur 208001, tel 9811122233", [(N, "Manish Tandon"), (A, "45 Civil Lines, Kanpur 208001"), (P, "9811122233")]),
    ("Meera Nambiar | 9447012345 | meera.n@kochi.net", [(N, "Meera Nambiar"), (P, "9447012345"), (E, "meera.n@kochi.net")]),
    ("Ravi Teja Varma (PAN BNZPV2288Q) opened the shop.", [(N, "Ravi Teja Varma"), (I, "BNZPV2288Q")]),
    ("The invoice 4417-22 of 12/03/2021 lists 40 bulbs at 1,250 rupees.", []),
    ("Our shop closes at 9 and opens at 10 on Sundays.", []),
    ("Consignment number 550912348 is missing.", []),
    ("Trains between Chennai and Mysuru are late.", []),
]


@pytest.fixture(scope="module")
def model():
    return pii.trained()


def test_held_out(model):
    hit = found = true = 0
    for c, gold in examples(400, seed=77):
        got = set(model.decode(c))
        hit, found, true = hit + len(got & gold), found + len(got), true + len(gold)
    assert hit >= 0.97 * found and hit >= 0.95 * true


def test_unseen(model):
    hit = found = true = 0
    wrong = []
    for text, gold in UNSEEN:
        got = {(k, text[s:e]) for s, e, k in pii.find(model, text, lexicon())}
        hit, found, true = hit + len(got & set(gold)), found + len(got), true + len(gold)
        wrong += [(text, got)] if got != set(gold) else []
    assert len(UNSEEN) >= 60 and hit >= 0.9 * true and hit >= 0.9 * found, wrong


@pytest.mark.skipif(not glob.glob("/root/testdata/sf*/documents.parquet"), reason="no test tables")
def test_no_sentence_is_from_the_documents():
    """No fixed part of a training sentence of 18 signs or more stands in a document."""
    import pandas as pd

    parts = {p.strip().lower() for p in fixed_parts() if len(p.strip()) >= 18}
    assert len(parts) > 80
    for path in glob.glob("/root/testdata/sf*/documents.parquet"):
        texts = "\n".join(t.lower() for t in pd.read_parquet(path, columns=["text"])["text"] if t)
        assert not [p for p in parts if p in texts], os.path.dirname(path)


def test_decode_is_optimal():
    """The dynamic programme finds the best set of segments that do not overlap."""
    r = random.Random(8)
    for _ in range(50):
        found = []
        for _ in range(8):
            s = r.randrange(20)
            found.append((s, s + r.randint(1, 6), "phone", [("phone", "x", r.randrange(5))]))
        m = pii.Model({f"phone|x|{k}": r.uniform(-2, 3) for k in range(5)})
        value = {(a, b): m.score(g) for a, b, _, g in found}
        best = 0.0
        for mask in range(1 << len(found)):
            chosen = sorted(c for k, c in enumerate(found) if mask >> k & 1)
            if all(a[1] <= b[0] for a, b in zip(chosen, chosen[1:])):
                best = max(best, sum(m.score(c[3]) for c in chosen))
        got = m.decode(iter(found))
        assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))
        assert sum(max(m.score(c[3]) for c in found if c[:2] == x[:2]) for x in got) >= best - 1e-9 and value


def test_marginals_are_those_of_all_segmentations():
    r = random.Random(3)
    for _ in range(20):
        spans = sorted({(s, s + r.randint(1, 3)) for s in (r.randrange(5) for _ in range(5))}, key=lambda x: (x[1], x[0]))
        score = [r.uniform(-2, 2) for _ in spans]
        z, p = 0.0, [0.0] * len(spans)
        for mask in range(1 << len(spans)):
            chosen = sorted(spans[k] for k in range(len(spans)) if mask >> k & 1)
            if all(a[1] <= b[0] for a, b in zip(chosen, chosen[1:])):
                w = 2.718281828459045 ** sum(score[k] for k in range(len(spans)) if mask >> k & 1)
                z += w
                for k in range(len(spans)):
                    p[k] += w * (mask >> k & 1)
        got = pii._marginals(spans, score, 9)
        assert max(abs(a / z - b) for a, b in zip(p, got)) < 1e-9


TEXT = (
    "Dear all,\nmy name is Karoti Belavra. Lot 5435-47 was sold. Ring me on +91 5959921833 tonight. E-mail: karoti.belavra[at]dinet[dot]example. "
    "Ship it to H. No. 98/6, Drumouchi Road, Mukhouli 487986. Card 4637 9127 1968. We told Karoti again. The tracking number 991731750 was noted."
)


def test_documents(spark, model):
    docs = [(1, TEXT), (2, TEXT), (3, None), (4, ""), (5, "No details here."), (6, ("Nothing to see. " * 4000) + "tel 5212.585.139."), (7, "मेरा नंबर 4364491735 है"), (8, "   \n "), (9, "?!(+")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("kinds", F.lit(1)).withColumn("redacted", F.lit("x")).withColumn("w", F.lit(2)).withColumn("t", F.lit(2))
    common = pii.common_words(df)
    assert {"the", "see"} <= common and "karoti" not in common
    rows = {(r["doc_id"], r["pii_kind"], r["found_text"]) for r in pii.found(df, model, common).collect()}
    one = {("person_name", "Karoti Belavra"), ("person_name", "Karoti"), ("phone", "+91 5959921833"), ("email", "karoti.belavra[at]dinet[dot]example"), ("address", "H. No. 98/6, Drumouchi Road, Mukhouli 487986"), ("id_number", "4637 9127 1968")}
    assert {r[1:] for r in rows if r[0] == 1} == one == {r[1:] for r in rows if r[0] == 2}
    assert {r[1:] for r in rows if r[0] == 6} == {("phone", "5212.585.139")} and {r[1:] for r in rows if r[0] == 7} == {("phone", "4364491735")}
    assert not {r for r in rows if r[0] in (3, 4, 5, 8, 9)}
    text = {r["doc_id"]: r["redacted"] for r in pii.details(df, model, common).collect()}
    assert "my name is [NAME]. Lot 5435-47 was" in text[1] and "told [NAME] again" in text[1] and 3 not in text and text[5] == "No details here."
    assert pii.found(df.where("false"), model, common).count() == 0 and len(pii.common_words(df.where("false"))) > 0


def test_a_hot_name_is_no_common_word(spark, model):
    """A name in every document is found in every document."""
    df = spark.createDataFrame([(k, f"The gate {k} was shut. Sincerely,\nVaruna Kestrin\n") for k in range(60)], "doc_id long, text string")
    rows = pii.found(df, model, pii.common_words(df)).collect()
    assert len(rows) == 60 and {r["found_text"] for r in rows} == {"Varuna Kestrin"}
