"""Phrases of the policy documents that decide roles, hints and skips."""

INSURED = "dit is verzekerd"
NOT_INSURED = "dit is niet verzekerd"
#: Horizontal centre from which a box belongs to the right column.
COLUMN_SPLIT = 300

#: Marks of lists that open a clause, as characters of a pattern.
CLAUSE_MARKS = r"\-•‣●◦"
#: Bullets that part the items inside a text.
BULLETS = "•‣●◦·"
#: Phrases that open a clause and say nothing, as a pattern.
CLAUSE_HEADERS = r"Bijzonderheden:|1\. Dit is verzekerd 2\. Dit is niet verzekerd\s+"
#: Abbreviations that end no sentence.
ABBREVIATIONS = ("max.", "p.p.", "btw.", "bovag.")
#: A question keeps the sentence that follows with this word.
FOLLOW = "Dan"
#: Beginnings of sentences that belong to the one before.
DEPENDENT = ("bijvoorbeeld", "dit betekent", "om dit te bepalen", "maar ", "en ", "of ", "dan ")
#: A text is cut before these.
MARKERS = ("Maximale vergoeding:", "Maximale vergoedingen:", "Bijzonderheden:", "Let op!")

LIMIT_STARTS = ("maximale vergoeding", "maximale vergoedingen")
CONDITION_STARTS = ("bijzonderheden",)
NEVER_TEXT_TITLE = "dit is nooit verzekerd"
NEVER_LIST_TITLE = "nooit verzekerd"
COVERED_LIST_TITLE = "verzekerd zijn"

VALUE_MATRIX = "samenvatting waardebepaling"
REPAIR_MATRIX = ("reparatie door:", "vrije reparatiekeuze")
FULL_PAYMENT, NO_PAYMENT, OWN_PAYMENT = "100% vergoeding", "geen vergoeding", "eigen bijdrage"
FIRST_YEAR = "In het eerste jaar van de verzekering geldt"
LATER_YEARS = "Na het eerste jaar geldt"

SKIP_PHRASES = (
    "ons kantoor staat",
    "ingeschreven bij de kvk",
    "ingeschreven in het handelsregister",
    "zonder moeilijke woorden",
    "dit noemen wij",
    "zie paragraaf",
    "hieronder lees je",
    "hiermee bedoelen we",
    "dit is de waarde",
    "de experts moeten zich houden",
    "om dit te bepalen",
    "heeft haar kantoor in rotterdam",
)
SKIP_HEADINGS = ("1. betaling bij schade", "4. de waarde van je auto", "maximale vergoeding:", "bijzonderheden:")
SKIP_STARTS = ("met schade bedoelen we",)
