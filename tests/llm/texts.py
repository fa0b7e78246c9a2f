"""Made-up texts for the tests of this folder."""

import random

SYLLABLES = {
    "en": "the ing tion er th and ou sh wh ly ea".split(),
    "fr": "le eau ou è é ment que çr ai tre".split(),
    "de": "sch ung keit ü ö ein pf tz ver zu".split(),
}


def word(rng, lang="en"):
    return "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))


def text(rng, n, lang="en", line=12):
    words = [word(rng, lang) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + line]) for i in range(0, n, line))


def rng(seed=1):
    return random.Random(seed)
