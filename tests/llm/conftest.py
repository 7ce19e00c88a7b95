import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_lines string, _h1 string, score string"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def sentence(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[x % len(WORDS)] + str(x // 97 % 50))
    return " ".join(out)


def odd_texts() -> list:
    """Nulls, empties, blanks, repeats, odd characters, a very long text and near copies."""
    base = sentence(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    return [
        None, "", "\n", " \t ", "\n\n\n", "one", "Two words", base, base, " ".join(near), base.upper(), "Shared line.\n" + sentence(2, 30), "shared LINE. \n" + sentence(3, 40), "  shared line.\t",
        "naïve café Übung ß 漢字 かな カタカナ 👍🏽  x　y", "tab\there\r\nand there\x0bmore\x0cend", "<|endoftext|> inside <|startoftext|>", "a  b   c\n\n\n d", "it's they're I'll 's 12,345.67 ...!?", "Copyright (c) 2020 Someone\nReleased under the MIT Licence.",
        "\n".join(["Shared line.", *[sentence(i, 9) for i in range(400)]]), "word " * 5000, "x" * 20000, sentence(9, 55) + "\n" + sentence(9, 55), "İstanbul ſtraße ΣΑΣ", "é combining", "퟿�",
    ]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 5 else None, None, "clash", "clash", "clash") for i, t in enumerate(odd_texts())]
    rows += [rows[7], rows[11], (None, "no id at all", None, None, 1, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
