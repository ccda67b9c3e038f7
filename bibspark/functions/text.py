"""Text columns: folding, tokens, stop words, stems, n-grams."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibspark.functions.paths import leaf

BETWEEN_TOKENS = r"[^\p{L}\p{N}]+"

# fixed values: accented small letters and what they fold to
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüýÿñç"
PLAIN = "aaaaaaeeeeiiiiooooouuuuyync"

# fixed values: the usual English stop set
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their then there "
    "these they this to was will with"
).split()


def fold(col: Column) -> Column:
    """Lower case without accents, composed or combining."""
    return F.regexp_replace(F.translate(F.lower(col), ACCENTED, PLAIN), r"\p{M}+", "")


def tokens(col: Column) -> Column:
    """Runs of letters and digits, lower case, in order."""
    return F.array_remove(F.split(F.lower(col), BETWEEN_TOKENS), "")


def stem(word: Column) -> Column:
    """Harman's S-stemmer: plural endings only."""
    return (
        F.when(word.rlike("[^ea]ies$"), F.regexp_replace(word, "ies$", "y"))
        .when(word.rlike("[^aeo]es$"), F.regexp_replace(word, "s$", ""))
        .when(word.rlike("[^us]s$"), F.regexp_replace(word, "s$", ""))
        .otherwise(word)
    )


def analyze(col: Column, stop: bool = True, stemmed: bool = True) -> Column:
    """Tokens without stop words, stemmed; each step may be left out for an exact twin."""
    out = tokens(col)
    if stop:
        out = F.filter(out, lambda w: ~w.isin(STOP_WORDS))
    return F.transform(out, stem) if stemmed else out


def ngram_list(words: Column, n: int) -> Column:
    """All runs of ``n`` words, joined by blanks."""

    def grams(ws):
        starts = F.when(F.size(ws) >= n, F.sequence(F.lit(1), F.size(ws) - (n - 1)))
        return F.transform(starts, lambda i: F.array_join(F.slice(ws, i, n), " "))

    # a lambda binds the word list once; a plain column would be computed anew for every run
    return F.get(F.transform(F.array(words), grams), F.lit(0))


def normal_phrase(col: Column) -> Column:
    """Folded words joined by single blanks, with one blank in front: a phrase prefix is then a substring."""
    return F.concat(F.lit(" "), F.array_join(tokens(fold(col)), " "))


# words between two texts of one record, so that no phrase goes from one to the next
GAP = 1 << 32


def texts(df: DataFrame, path: str) -> Column:
    """The texts under a path as one array: a text alone, or all of an array, at any depth."""
    return leaf(df, path).values


def placed(lists: Column) -> Column:
    """(term, position) of every word of an array of word lists; each list begins a gap behind the one before."""
    return F.flatten(F.transform(lists, lambda ws, e: F.transform(ws, lambda w, i: F.struct(w.alias("term"), (e.cast("bigint") * GAP + i).alias("position")))))


def by_word(words: Column) -> Column:
    """(term, positions) of the different words in an array of (term, position), inside the row: sorted, then cut where the word changes."""

    def groups(rows):
        starts = F.filter(F.sequence(F.lit(0), F.size(rows) - 1), lambda i: (i == 0) | (F.get(rows, i)["term"] != F.get(rows, i - 1)["term"]))

        def group(start, n, bounds):
            own = F.slice(rows, start + 1, F.coalesce(F.get(bounds, n + 1), F.size(rows)) - start)
            return F.struct(F.get(rows, start)["term"].alias("term"), F.transform(own, lambda x: x["position"]).alias("positions"))

        return F.get(F.transform(F.array(starts), lambda bounds: F.transform(bounds, lambda start, n: group(start, n, bounds))), F.lit(0))

    # a lambda binds the sorted words, and the bounds, once
    return F.get(F.transform(F.filter(F.array(F.sort_array(words)), lambda rows: F.size(rows) > 0), groups), F.lit(0))
