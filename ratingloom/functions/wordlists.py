"""Word lists of the text operators."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover

# The words of the restaurant domain that word counts are limited to.
RESTAURANT_WORDS = [
    "food", "restaurant", "service", "staff", "menu", "drink", "meal", "dish", "chef",
    "waiter", "waitress", "ambiance", "dining", "delicious", "taste", "flavor", "appetizer",
    "main", "course", "dessert", "bills", "tip", "reservation", "sitting", "cooking",
    "presentation", "bar", "table", "order", "eat", "served", "customers", "experience",
    "spicy", "hot", "cold", "sommelier", "waitlist", "specials", "birthday", "celebration",
    "gourmet", "fresh", "local", "organic", "price", "rude", "polite", "helpful",
]

# Fixed values of the published sentiment rules (Hutto and Gilbert, ICWSM 2014).
BOOST = 0.293
CAPITALS = 0.733
NEGATION = -0.74
NORM = 15.0
EXCLAMATION = 0.292
QUESTION = 0.18
QUESTIONS_MANY = 0.96
INTENSIFIERS = [
    "absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly", "deeply",
    "effing", "enormously", "entirely", "especially", "exceptionally", "extremely", "fabulously",
    "flipping", "flippin", "fricking", "frickin", "frigging", "friggin", "fully", "fucking",
    "greatly", "hella", "highly", "hugely", "incredibly", "intensely", "majorly", "more", "most",
    "particularly", "purely", "quite", "really", "remarkably", "so", "substantially",
    "thoroughly", "totally", "tremendously", "uber", "unbelievably", "unusually", "utterly",
    "very",
]
DAMPENERS = [
    "almost", "barely", "hardly", "kinda", "kindof", "kind-of", "less", "little", "marginally",
    "occasionally", "partly", "scarcely", "slightly", "somewhat", "sorta", "sortof", "sort-of",
]
DAMPENING_PAIRS = ["just enough", "kind of", "sort of"]
NEGATIONS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "ain't", "aren't",
    "can't", "couldn't", "daren't", "didn't", "doesn't", "dont", "hadnt", "hasnt", "havent",
    "isnt", "mightnt", "mustnt", "neither", "don't", "hadn't", "hasn't", "haven't", "isn't",
    "mightn't", "mustn't", "neednt", "needn't", "never", "none", "nope", "nor", "not", "nothing",
    "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent", "oughtn't", "shan't",
    "shouldn't", "uh-uh", "wasn't", "weren't", "without", "wont", "wouldnt", "won't", "wouldn't",
    "rarely", "seldom", "despite",
]
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "yeah right": -2.0,
    "cut the mustard": 2.0, "kiss of death": -1.5, "hand to mouth": -2.0,
}
PUNCTUATION = [
    ".", "!", "?", ",", ";", ":", "-", "'", '"', "!!", "!!!", "??", "???", "?!?", "!?!",
    "?!?!", "!?!?",
]


def english_stop_words() -> list[str]:
    """The English stop words that ship with Spark."""
    return StopWordsRemover.loadDefaultStopWords("english")
