"""Expense category to account mapping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import blank, strip

DEFAULT_ACCOUNT = "31"

# Category keys and account ids, in match order.
CATEGORY_RULES = (
    ("accounting", "69"), ("advertising", "7"), ("automobile", "55"), ("auto", "55"),
    ("bank charges", "8"), ("bookkeeper", "70"), ("building repairs", "73"),
    ("commissions", "9"), ("fees", "9"), ("cost of labor", "59"), ("labor", "59"),
    ("decks", "64"), ("patios", "64"), ("disposal", "28"), ("dues", "10"),
    ("subscriptions", "10"), ("equipment rental", "62"), ("equipment", "29"),
    ("equipment repairs", "75"), ("repairs", "75"), ("fountain", "65"),
    ("garden lighting", "65"), ("lighting", "65"), ("fuel", "56"),
    ("gas and electric", "76"), ("gas", "76"), ("electric", "76"),
    ("installation", "60"), ("insurance", "11"), ("job expenses", "58"),
    ("job materials", "63"), ("materials", "63"), ("lawyer", "71"), ("legal", "12"),
    ("professional fees", "12"), ("maintenance", "72"), ("maintenance and repair", "72"),
    ("meals", "13"), ("entertainment", "13"), ("office", "15"), ("office expenses", "15"),
    ("permits", "68"), ("plants", "66"), ("soil", "66"), ("plants and soil", "66"),
    ("promotional", "16"), ("purchases", "78"), ("rent", "17"), ("lease", "17"),
    ("sprinklers", "67"), ("drip systems", "67"), ("stationery", "19"), ("printing", "19"),
    ("supplies", "20"), ("taxes", "21"), ("licenses", "21"), ("telephone", "77"),
    ("phone", "77"), ("travel", "22"), ("travel meals", "23"), ("utilities", "24"),
    ("workers compensation", "57"), ("workers comp", "57"),
)


def category_to_account(
    category: Column, default: str = DEFAULT_ACCOUNT, blank_matches_first: bool = False
) -> Column:
    """Account of a category: exact key, else the first rule in order where the key
    and the category contain one another, else ``default``.

    Evaluated in the row over a constant array of rules, so it needs no join. (A CASE
    with two branches per rule grows past what the JVM compiles and is slower.)
    A whitespace-only category is blank unless ``blank_matches_first`` is set.
    """
    accounts = F.create_map(*[F.lit(x) for rule in CATEGORY_RULES for x in rule])
    keys = F.array(*[F.lit(key) for key, _ in CATEGORY_RULES])

    def account(text: Column) -> Column:
        near = F.filter(keys, lambda key: F.contains(text, key) | F.contains(key, text))
        first = F.try_element_at(accounts, F.get(near, F.lit(0)))
        return F.coalesce(F.try_element_at(accounts, text), first, F.lit(default))

    # The one-element array binds the cleaned text, so it is not computed per rule.
    found = F.get(F.transform(F.array(F.lower(strip(category))), account), F.lit(0))
    nothing = blank(category) if blank_matches_first else blank(strip(category))
    return F.when(nothing, F.lit(default)).otherwise(found)
