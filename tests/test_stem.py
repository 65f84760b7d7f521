from textlab.functions.stem import german_stem


def test_reference_stems():
    # Stems that occur in the reference's learned rules.
    cases = {"politik": "polit", "demokratie": "demokrati", "bekämpfung": "bekampf", "für": "fur",
             "bildung": "bildung", "leben": "leb", "zugewanderte": "zugewandert", "inklusion": "inklusion",
             "politische": "polit", "demokraten": "demokrat", "sozialen": "sozial", "von": "von"}
    for w, s in cases.items():
        assert german_stem(w) == s, (w, german_stem(w), s)


def test_snowball_examples():
    # Examples from the published German stemmer vocabulary.
    cases = {"aufeinanderfolgenden": "aufeinanderfolg", "kategorischen": "kategor", "häuser": "haus",
             "gesundheit": "gesund", "freundlichkeit": "freundlich", "ergebnisse": "ergebnis",
             "möglichkeiten": "moglich", "bedeutung": "bedeut", "straße": "strass", "kenntnisse": "kenntnis"}
    for w, s in cases.items():
        assert german_stem(w) == s, (w, german_stem(w), s)
