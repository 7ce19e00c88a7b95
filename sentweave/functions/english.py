"""English sentence boundaries and tokens: row-local column expressions over word arrays.

Whether a sentence ends after a word follows from a code of six letters: what kind of mark the word has, what the next two
words are, and three things about what stands before the mark. ``ENDS`` lists the codes that end a sentence. Tokens are
the matches of one regular expression for each group of languages; a second look decides about closing periods.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentweave.functions.text import bind

#: Titles before a name, abbreviations that end a sentence, time zones, closing marks.
HONORIFICS = "Adj. Adm. Adv. Asst. Bart. Brig. Bros. Capt. Cmdr. Col. Comdr. Con. Cpl. Dr. Ens. Gen. Gov. Hon. Hosp. Insp. Lt. M. MM. Maj. Messrs. Mlle. Mme. Mr. Mrs. Ms. Msgr. Op. Ord. Pfc. Ph. Prof. Pvt. Rep. Reps. Res. Rev. Rt. Sen. Sens. Sfc. Sgt. Sr. St. Supt. Surg. vs. v.".split()
TERMINALS = ["Esq", "Jr", "Sr", "M.D"]
TIME_ZONES = ["EDT", "CST", "EST"]
RIGHT_PARENS = ["}", ")", "-RBR-"]
RIGHT_QUOTES = ["'", "''", "'''", '"', "'\""]
#: Abbreviations whose period stays with them always, or before a number.
PREFIXES = {
    "en": "A B C D E F G H I J K L M N O P Q R S T U V W X Y Z Adj Adm Adv Asst Bart Bldg Brig Bros Capt Cmdr Col Comdr Con Corp Cpl DR Dr Drs Ens Gen Gov Hon Hr Hosp Insp Lt MM MR MRS MS Maj Messrs Mlle Mme Mr Mrs Ms Msgr Op Ord Pfc Ph Prof Pvt Rep Reps Res Rev Rt Sen Sens Sfc Sgt Sr St Supt Surg v vs i.e rev e.g Nos Nr".split(),
}
NUMERIC_PREFIXES = {"en": ["No", "Art", "pp"]}


def words_of(c: Column) -> Column:
    """White-space separated words."""
    return F.filter(F.split(c, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def capital(w: Column) -> Column:
    return w.rlike("^[A-Z]")


#: What the next word is, in order: nothing, a capital, double quote or backtick, single quote, opening bracket, the closing
#: bracket by its treebank name, another closing bracket, a dash, a lone period; else ``o``.
FOLLOWERS = {"C": "^[A-Z]", "B": "^[\"`]", "A": "^'", "P": "^([{(]|-LBR-)", "r": "^-RBR-$", "R": "^[})]$", "D": "^--$", "S": "^\\.$"}
#: Codes of sentence ends. 1st letter: l for a bare ? or !, p for a bare period, c for a mark before a closing bracket or quote, x for one
#: before anything else. 2nd and 3rd: the next words (N: there is none). 4th, of what stands before the mark: n a title, a time before its
#: zone or a quoted word, t an abbreviation that may end a sentence, i initials, o other. 5th: q if it ends in a quote. 6th: e if it is empty.
ENDS = [
    "[lpcx]NN...",  # the text's end
    "c[BPC]....",
    "l[CBAS]....",
    "l[Dr]C...",
    "p[BAPR]....",
    "pr[^D]...",
    "pS...[^e]",
    "pDC.[^q].",
    "pD[BA]...",
    "pC.[to]..",
]
END = "^(" + "|".join(ENDS) + ")$"
#: A word that may end a sentence: before its last mark, the mark, and what follows the mark.
MARKED = "(?s)^(.*)([.?!])([^.?!]*)$"


def _follower(w: Column, nothing: Column) -> Column:
    kind = F.when(nothing, "N")
    for letter, pattern in FOLLOWERS.items():
        kind = kind.when(w.rlike(pattern), letter)
    return kind.otherwise("o")


def boundary_code(word: Column, next_: Column, after: Column) -> Column:
    """The six letters of a word with one of ``.?!``; ``next_`` and ``after`` are the words that follow it, empty at the end."""
    before, mark, behind = (F.regexp_extract(word, MARKED, i) for i in (1, 2, 3))
    last = (next_ == "") & (after == "")
    kind = F.when(behind == "", F.when(mark == ".", "p").otherwise("l")).when(behind.isin(*RIGHT_PARENS, *RIGHT_QUOTES), "c").otherwise("x")
    timed = before.isin("p.m", "a.m") & F.substring(next_, 1, 3).isin(*TIME_ZONES)
    left = F.when(F.concat(before, F.lit(".")).isin(*HONORIFICS) | timed | before.rlike("^['\"`]"), "n").when(before.isin(*TERMINALS), "t").when(before.rlike("^([A-Z]\\.)*[A-Z]$"), "i").otherwise("o")
    return F.concat(kind, _follower(next_, last), _follower(after, last), left, F.when(before.rlike("['\"]$"), "q").otherwise("-"), F.when(before == "", "e").otherwise("-"))


def ends_sentence(word: Column, next_: Column, after: Column) -> Column:
    """Whether a sentence ends after ``word``."""
    return F.when(word.rlike("[.?!]"), boundary_code(word, next_, after).rlike(END)).otherwise(False)


def split_english(c: Column) -> Column:
    """Sentences of a paragraph, each with single blanks between its words."""

    def marked(words: Column) -> Column:
        at = lambda i: F.coalesce(F.get(words, i), F.lit(""))
        return F.transform(words, lambda w, i: F.concat(w, F.when(ends_sentence(w, at(i + 1), at(i + 2)), F.lit("\n")).otherwise(F.lit(" "))))

    return F.transform(F.filter(F.split(F.array_join(bind(words_of(c), marked), ""), "\n"), lambda s: F.trim(s) != ""), lambda s: F.trim(s))


_LETTER, _NUMBER = "\\p{IsAlphabetic}", "[\\p{Nd}\\p{Nl}]"
#: What goes on within a word: letters, digits, hyphens, a lone period, a comma between numbers.
_INNER = f"[{_LETTER}\\p{{Nd}}-]|(?<!\\.)\\.(?!\\.)|(?<={_NUMBER}),(?={_NUMBER})"
_REST = "''|\\S"
#: One pattern for each group of languages: English contractions go with what follows the apostrophe, French and Italian ones with what
#: precedes it, and elsewhere an apostrophe stands alone. Runs of periods stay together. The loops are possessive: nothing after
#: them asks for a character back, and Java follows them without a call for each, so that a token may have any length.
TOKENS = {
    "en": f"\\.{{2,}}+|(?:(?<={_LETTER})'(?={_LETTER})|(?<={_NUMBER})'(?=s))?(?:{_INNER}|(?<=\\p{{Nd}})'(?!s)(?={_LETTER}))++|{_REST}",
    "fr": f"\\.{{2,}}+|(?:{_INNER})++(?:(?<={_LETTER})'(?={_LETTER}))?|{_REST}",
    "other": f"\\.{{2,}}+|(?:{_INNER})++|{_REST}",
}
_GROUPS = {"en": "en", "fr": "fr", "it": "fr"}


def tokens(c: Column, language: str = "en", prefixes: dict[str, int] | None = None) -> Column:
    """Tokens of a line.

    ``prefixes``: another language's abbreviations (``readers.prefixes`` reads them from a file), 1 for such whose period
    always stays with them, 2 for such before a number; without them, those of the language or else English ones count.
    """
    if prefixes is None:
        prefixes = dict.fromkeys(PREFIXES.get(language, PREFIXES["en"]), 1) | dict.fromkeys(NUMERIC_PREFIXES.get(language, NUMERIC_PREFIXES["en"]), 2)
    always, numeric = ([p for p, kind in prefixes.items() if kind == k] for k in (1, 2))
    found = F.regexp_extract_all(F.translate(c, "`", "'"), F.lit(TOKENS[_GROUPS.get(language, "other")]), F.lit(0))

    def settled(words: Column) -> Column:
        def one(w: Column, i: Column) -> Column:
            stem, following = F.regexp_replace(w, "\\.$", ""), F.coalesce(F.get(words, i + 1), F.lit(""))
            stays = (stem.contains(".") & stem.rlike(f"[{_LETTER}]")) | stem.isin(*always) | following.rlike("^\\p{Ll}") | (stem.isin(*numeric) & following.rlike("^[0-9]"))
            closes = w.rlike("[^.]\\.$") & ~stays
            return F.when(w == "''", F.array(F.lit('"'))).when(closes, F.array(stem, F.lit("."))).otherwise(F.array(w))

        return F.flatten(F.transform(words, one))

    return bind(found, settled)


def tokenize(c: Column, language: str = "en", prefixes: dict[str, int] | None = None) -> Column:
    """Tokens of a line as one string with single blanks between them."""
    return F.array_join(tokens(c, language, prefixes), " ")
