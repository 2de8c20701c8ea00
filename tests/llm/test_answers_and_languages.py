"""Problems 2 and 4: cases by hand, held-out accuracy, edge rows."""

import pytest

from askmill.llm import answer_defects as A
from askmill.llm import language as L

QUESTION = "farmer from Abapur village asks how to control rust in wheat, orange dust, 4 acre, variety Abadev"
GOOD = "Rust in wheat is best managed early. Spray Abazol at 2 ml per litre of water. Keep the label of every pack for later reference."


@pytest.mark.parametrize("answer", [None, "", "  ", "N/A", "[]", "```\n```", "**ANSWER**:", "-", "null", "Answer: \n"])
def test_empty(answer):
    assert A.is_empty(answer)


#: Refusals that none of the test tables has.
REFUSALS = [
    "We regret that no guidance is available from this desk.", "I cannot provide an opinion on that.", "It isn't possible for me to answer.", "Our policy forbids advice on this.", "This topic is beyond our remit.",
    "I'm afraid I can't help you there.", "I won't be able to assist with this.", "Sorry, we do not have any information about it.", "I have no knowledge of this matter.", "I lack the expertise to judge this.",
    "I would rather not comment.", "We must refuse to respond.", "This service is not permitted to give medical opinions.", "No recommendation will be made here.", "An answer cannot be given at this time.",
    "That is not something I can discuss.", "I prefer to abstain from answering.", "It would be inappropriate for me to suggest a dose.", "The rules do not let me answer such questions.", "My training doesn't permit me to reply.",
    "This request exceeds my area of expertise.", "There is nothing we can offer on this.", "I am not qualified to advise you.", "I'm not authorised to share those details.", "The assistant can't respond to such requests.",
    "Your question will remain unanswered.", "We are unable to process this question.", "I am not in a position to guide you.", "I have to decline.", "I refuse to answer that.",
    "It is not appropriate for us to take a view.", "Advice on this subject is not provided.", "I don't have the details needed to reply.", "We cannot support you with that request.", "I could not possibly say.",
    "Guidelines prevent me from saying more.", "This lies outside what I know.", "I'm unable to offer suggestions.", "Regrettably we will not comment.", "I must leave this to others.",
    "Nothing I am allowed to say would help.", "Such a matter is not within my competence.", "I shall pass.", "This is not a subject I can advise on.",
]
ADVICE = [
    GOOD, "I cannot overstress early scouting against rust in wheat. Keep bunds clean.", "Chemicals cannot cure leaves already damaged.", "Sorry to hear about the loss; most of the stand can still be saved.", "Do not spray in wind or during the hottest hours.",
    "You cannot save the fallen fruit, but the rest can be protected. Tie bands round the trunk. Bury the fruit.", "No cure is needed; the leaves recover after rain.", "Never leave cut canes in the field.", "Do not allow water to stand. Open the drains.", "Help the plants with a light dose of urea. Repeat after ten days.",
    "It is not right to burn stubble. Mix it into the soil.", "We recommend neem oil. Spray at dusk. Repeat weekly.", "Store the grain dry. I would not sow before June. Mix seed with ash.", "If the pest cannot be controlled, call the block office. Spray twice. Burn the stalks.", "Give no water for a week. Provide shade.",
]


def test_refusals():
    assert len(REFUSALS) >= 40
    missed = [x for x in REFUSALS if not A.is_refusal(x)]
    assert len(missed) <= 0.1 * len(REFUSALS), missed
    long = "Thank you for writing. We read all letters. This is a hard matter. Many people ask about it. I cannot advise on it. Please ask somebody else."
    assert A.is_refusal(long) and A.is_refusal(f"{GOOD[:34]} {'I am sorry, but I am not able to help with this request. ' * 3}")
    old = ["I am sorry, but I can't give advice on this topic.", "Regrettably, this falls outside what I may advise on. Please understand.", "No answer can be provided for this question.", "There is nothing I am permitted to say here.", "As an automated assistant, it would not be appropriate for me to recommend anything here."]
    assert all(A.is_refusal(x) for x in old)


@pytest.mark.parametrize("answer", ADVICE)
def test_no_refusals(answer):
    assert not A.is_refusal(answer)


def test_copies():
    copy = lambda q, a: A.Pair(q, a).is_copy()
    assert copy(QUESTION, QUESTION.upper() + "?") and copy(QUESTION, f"You asked: {QUESTION}") and copy(QUESTION, f"{QUESTION} / {QUESTION}")
    assert copy(QUESTION, f"{QUESTION}. " * 4) and copy(QUESTION, f"{QUESTION}. " * 400)
    assert copy(QUESTION, QUESTION.replace("rust", "rsut").replace("4 acre", "acre 4"))
    assert not copy(QUESTION, GOOD) and not copy(QUESTION, f"You asked: {QUESTION}?\n{GOOD}") and not copy(None, GOOD)


def test_languages_of_answers():
    foreign = lambda a: A.Pair(None, a).is_foreign()
    assert foreign("खेत को खरपतवार से मुक्त रखें।") and foreign("Khet ko kharpatwar se mukt rakhen. Teen din baad halki sinchai karen.")
    assert not foreign(GOOD) and not foreign("Advice: keep the plot clean and drain standing water.")


#: For each construct an answer that breaks off in it and, but for that, ends with a full stop, and its whole form.
CONSTRUCTS = {
    "fence": ("Do this:\n```\nspray at dawn.", "Do this:\n```\nspray at dawn.\n```\nThat is all."),
    "tilde fence": ("Do this:\n~~~\nspray at dawn.", "Do this:\n~~~\nspray at dawn.\n~~~"),
    "inline code": ("Set `rate = 2.", "Set `rate = 2` now."),
    "round bracket": ("Use sprays (early ones.", "Use sprays (early ones)."),
    "square bracket": ("See [the label.", "See [the label]."),
    "double quote": ('Tell him "wait for rain.\nThen sow.', 'Tell him "wait for rain.\nThen sow."'),
    "curved quote": ("Tell him “wait for rain. Then sow.", "Tell him “wait for rain. Then sow.”"),
    "bold": ("Wear **gloves and boots.", "Wear **gloves** and boots."),
    "emphasis": ("Wear *gloves and boots.", "Wear *gloves* and boots."),
    "underscore": ("Wear _gloves and boots.", "Wear _gloves_ and boots."),
    "tag": ("Steps: <ul><li>Drain water.</li>", "Steps: <ul><li>Drain water.</li></ul>"),
    "tag cut": ("Drain water. <br", "Drain water. <br/>"),
    "list item": ("Do this.\n1. Spray early.\n2.", "Do this.\n1. Spray early.\n2. Rest."),
    "bullet": ("Do this.\n- Spray early.\n-", "Do this.\n- Spray early.\n- Rest."),
    "heading": ("Drain water.\n## ", "Drain water.\n## Care\nRest."),
    "label": ("Drain water.\nDosage:", "Drain water.\nDosage:\nTwo spoons."),
    "table row": ("| dose | day |\n| 2 ml | 3 |\n| 4 ml.", "| dose | day |\n| 2 ml | 3 |\n| 4 ml | 5 |"),
    "clause": ("Drain water,", "Drain water, then sow."),
    "dots": ("Spray 3 ml per …", "Wait … then spray."),
    "dash": ("Spray at dusk –", "Spray at dusk – not at noon."),
}


@pytest.mark.parametrize("name", CONSTRUCTS)
def test_the_stack_finds_each_construct(name):
    broken, whole = CONSTRUCTS[name]
    assert A.parse(broken)[0], A.frames(broken)
    assert not A.parse(whole)[0], A.frames(whole)


def test_parser():
    broken = ["Table of doses (", "Do this:\n1. Spray early.\n2.", "It is **impor", "Wash hands and...", "He said (see \"label", "x <b>bold"]
    assert all(A.parse(x)[0] for x in broken)
    assert not any(A.parse(x)[0] for x in [GOOD, GOOD[:-1], "1. Spray early.\n2. Drain water.", "Mix 3 * 4 spoons.", "Keep 5 < 6 ml.", "Use a 6\" pipe.", "The farmer's field isn't dry.", "a) Drain.\nb) Sow.", "Snake_case and don't.", "---\nDrain.\n---", "Rate: 3.5 ml/l, 10:30 am.", "He said \"go.\"", "Drain (see label.)", "Use *care.\n\nDrain water."])
    assert A.parse("Drain the field in the")[1] == "Drain the field in the" and A.parse('He said "go."') == (False, "")


def test_tiles():
    assert A.tiles("a b c d e".split(), "c d x a b".split()) == [True, True, False, True, True]
    assert A.tiles([], ["a"]) == [False]


def test_defects(spark, rows):
    good = [(f"g{k}", QUESTION, "Pest", GOOD) for k in range(6)]
    data = good + good[:2] + [
        ("e", QUESTION, "Pest", None), ("i", QUESTION, " irrelevant_crop ", ""), ("t", QUESTION, "Pest", GOOD[:70]), ("s", QUESTION, "Pest", GOOD[:-1]), ("p", QUESTION, "PARSE_ERROR", GOOD),
        ("c", QUESTION, None, QUESTION), ("r", None, None, "I am unable to comment on the matter."), ("o", None, None, "मेरे खेत में फसल खड़ी है"), ("l", QUESTION, "Pest", (GOOD + " ") * 2000), (None, QUESTION, "Pest", GOOD),
    ]
    df = spark.createDataFrame(data, "unique_q_id string, question string, category string, answer string")
    assert rows(A.defects(df)) == [("c", "copied_question"), ("e", "empty"), ("o", "other_language"), ("r", "refusal"), ("t", "truncated")]
    assert A.defects(df.where("false")).count() == 0


EN = ["the leaves are turning yellow from the edges", "please tell me which medicine to spray", "there was heavy rain and water is standing in the field", "how much fertiliser do I give"]
HI = ["पत्तियाँ किनारे से पीली पड़ रही हैं", "कौन सी दवा छिड़कें कृपया बताइए", "khaad kitni daalni hai", "aadhe phool gir chuke hain", "kaun si dawa chhidken kripya bataiye"]
MR = ["पानांच्या कडा पिवळ्या पडत आहेत", "कोणते औषध फवारावे ते सांगा", "khat kiti takayche aahe", "konte aushadh phavarave te sanga"]
TA = ["உரம் எவ்வளவு போட வேண்டும்", "பாதி பூக்கள் உதிர்ந்துவிட்டன"]


@pytest.fixture(scope="module")
def model():
    samples = [(k, t) for k, ts in (("en", EN), ("hi", HI), ("mr", MR), ("ta", TA)) for t in ts]
    noisy = [(k, f"{a}, {b}") for k, ts in (("en", EN), ("hi", HI), ("mr", MR), ("ta", TA)) for a in ts for b in ts for _ in range(3)] + [("hi", EN[0]), ("en", TA[0])]
    return L.train(noisy, samples)


def langs(model, text):
    return [s[0] for s in L.segment(model, [text], {})[0]]


def test_segments(model):
    assert langs(model, EN[0]) == ["en"] and langs(model, HI[2]) == ["hi"] and langs(model, MR[2]) == ["mr"]
    assert langs(model, f"{HI[0]}, {EN[1]}. {TA[0]}") == ["hi", "en", "ta"]
    assert langs(model, f"{EN[0]} {MR[0]}") == ["en", "mr"]
    assert langs(model, "पत्तियाँ Tomato किनारे से पीली पड़ रही हैं") == ["hi"]
    assert langs(model, f"{HI[0]} {HI[4]}") == ["hi"]  # one language in two scripts
    assert langs(model, "123 ... ?!") == [] and langs(model, "") == []


def test_confidence_and_held_out(model):
    for k, t in (("en", "water is standing and the leaves are yellow"), ("hi", "किनारे पीली पड़ रही हैं"), ("mr", "औषध सांगा"), ("ta", "பூக்கள் வேண்டும்")):
        (lang, confidence, first, last), = L.segment(model, [t], {})[0]
        assert lang == k and 0.25 < confidence <= 1 and (first, last) == (0, len(t.split()))


def test_confidence_is_calibrated():
    """Expected calibration error on fresh texts of one to six words, from labels of which a tenth is wrong."""
    import random

    import numpy as np

    r = random.Random(4)
    pools = {k: sorted({w for t in ts for w in L.tokens(t)[0]}) for k, ts in (("en", EN), ("hi", HI), ("mr", MR), ("ta", TA))}
    pools["en"] += pools["hi"][:3]  # borrowed words
    pools["mr"] += pools["hi"][3:8]

    def texts(n, longest):
        return [(k, " ".join(r.choice(pools[k]) for _ in range(r.randint(1, longest)))) for k in r.choices(list(pools), k=n)]

    noisy = [(k if r.random() > 0.1 else r.choice(list(pools)), t) for k, t in texts(3000, 9)]
    m = L.train(noisy, [(k, t) for k, ts in (("en", EN), ("hi", HI), ("mr", MR), ("ta", TA)) for t in ts])
    confidence, right = [], []
    for k, t in texts(2000, 6):
        for lang, c, _, _ in L.segment(m, [t], {})[0]:
            confidence.append(c)
            right.append(lang == k)
    assert L.calibration_error(np.array(confidence), np.array(right)) <= 0.05 and 0.25 < m.temperature
    assert abs(L.calibration_error(np.array([0.9] * 10), np.array([1] * 5 + [0] * 5)) - 0.4) < 1e-9


def test_a_long_word_is_read_whole(model):
    assert len(L.grams("a" * 1000)) > 4000 and langs(model, "x" * 50_000 + " " + EN[0])[-1] == "en"


def test_log(spark, rows, model):
    data = [(1, EN[0], "en"), (2, EN[0], None), (3, EN[0], "und"), (4, EN[0], "hi"), (5, f"{EN[0]}. {TA[1]}", "en"), (6, None, "en"), (7, "  ", ""), (8, "?!", "en"), (9, f"{EN[0]} " * 3000, "te"), (9, f"{EN[0]} " * 3000, "te")]
    df = spark.createDataFrame(data, "raw_row_id long, querytext string, lang_label string").withColumn("lang", __import__("pyspark").sql.functions.lit("x"))
    got = rows(L.mislabelled(df, model).select("raw_row_id", "segment_no", "lang"))
    assert got == [(2, 1, "en"), (3, 1, "en"), (4, 1, "en"), (5, 1, "en"), (5, 2, "ta"), (9, 1, "en"), (9, 1, "en")]
    assert L.mislabelled(df.where("false"), model).count() == 0
    assert L.segments(df, L.train([], []), "raw_row_id", "querytext").where("confidence > 0.5").count() == 0
