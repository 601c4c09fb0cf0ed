"""Word lists and the expressions that weigh a text with them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# The theme labels, in the order that settles ties.
THEMES = ["Punctuality", "Service Quality", "Professionalism", "Pricing", "Communication", "No Complaint", "Other"]
NO_COMPLAINT, OTHER = "No Complaint", "Other"


@dataclass(frozen=True)
class Lexicon:
    """Word weights per polarity, and keywords per theme (all lower case, a-z).

    The words are literals of the plan, looked up in a set for each token.
    """

    positive: dict[str, int] = field(default_factory=dict)
    negative: dict[str, int] = field(default_factory=dict)
    themes: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        unknown = set(self.themes) - set(THEMES)
        if unknown:
            raise ValueError(f"unknown themes: {sorted(unknown)}")


def _weights(value: int, words: str) -> dict[str, int]:
    return {w: value for w in words.split()}


#: General English words of praise and complaint, and words that point to a theme; a starting point to be adapted.
SERVICE_LEXICON = Lexicon(
    positive={
        **_weights(1, "good nice fine glad happy pleased pleasant kind friendly helpful honest fair easy smooth quick fast tidy "
                      "clean neat reliable efficient thorough like liked enjoy enjoyed thanks thank well better safe calm smart"),
        **_weights(2, "excellent superb brilliant fantastic fabulous awesome amazing wonderful perfect great best love loved "
                      "outstanding delighted delightful impressive exceptional flawless"),
    },
    negative={
        **_weights(1, "bad wrong slow late dirty messy sad upset angry annoyed annoying unhappy careless lazy mistake fault faulty "
                      "fail failed failure damage damaged dull weak worse noisy missing lost problem trouble unfair confusing expensive overpriced"),
        **_weights(2, "terrible horrible awful dreadful disgusting useless pathetic worst rude hate hated scam fraud cheat cheated "
                      "unacceptable disappointed disappointing appalling dangerous broken ruined"),
    },
    themes={
        "Punctuality": "late early delay delays delayed wait waited waiting hour hours minute minutes schedule overdue tardy punctual".split(),
        "Service Quality": "quality fault faulty defect defects leak leaking broken damage damaged repair repaired fixed finish unfinished".split(),
        "Professionalism": "rude polite manners attitude behave behaved behaviour careless lazy skilled trained untrained respect".split(),
        "Pricing": "price prices priced cost costs cheap expensive fee fees bill billed charge charged refund money overpriced".split(),
        "Communication": "call called calls phone phoned email message messages reply replied answer answered inform informed contact".split(),
    },
)


def tokens(text: Column) -> Column:
    """Lower-case a-z words of the whole text."""
    return F.split(F.lower(text), "[^a-z]+")


def occurrences(words: Column, wanted: list[str]) -> Column:
    if not wanted:
        return F.lit(0)
    return F.size(F.filter(words, lambda w: w.isin(list(wanted))))


def weight(words: Column, weights: dict[str, int]) -> Column:
    """Sum of word weights: one set lookup per token and distinct weight."""
    total = F.lit(0)
    for value in sorted(set(weights.values())):
        total = total + F.lit(value) * occurrences(words, [w for w, v in weights.items() if v == value])
    return total


#: A text is mixed unless one side's weight is more than this many times the other's.
PREVAILS = 3


def polarity(positive: Column, negative: Column) -> Column:
    """Label from the two weighted sums."""
    return (
        F.when((positive == 0) & (negative == 0), "neutral")
        .when(negative > positive * PREVAILS, "negative")
        .when(positive > negative * PREVAILS, "positive")
        .otherwise("mixed")
    )


def leading_theme(counts: dict[str, Column], sentiment: Column) -> Column:
    """Theme with most keywords; the fixed order settles ties, sentiment the rest."""
    fallback = F.when(sentiment.isin("negative", "mixed"), OTHER).otherwise(NO_COMPLAINT)
    named = [t for t in THEMES if t in counts]
    if not named:
        return fallback
    most = F.greatest(*[counts[t] for t in named], F.lit(0))
    chosen = F.coalesce(*[F.when(counts[t] == most, F.lit(t)) for t in named])
    return F.when(most > 0, chosen).otherwise(fallback)
