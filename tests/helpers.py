"""Fixture frames of dictionary entries."""

ES = "row_idx long, word string, ipa string, pos string, definitions array<string>, translations_he array<string>, translations_en array<string>, frequency_rank int"
HE = "row_idx long, word string, ipa string, definitions array<string>, translations_es array<string>"
BRIDGE = "row_idx long, source_lang string, word string, ipa string, pos string, definitions array<string>, translations_es array<string>, translations_he array<string>"


def spanish(spark):
    return spark.createDataFrame([
        (0, "casa", "ˈka.sa", "noun", ["Edificio para habitar"], ["בית"], ["house"], 1),
        (1, "banco", "ˈbaŋ.ko", "noun", ["Asiento largo", "Institución financiera"], ["ספסל", "בנק"], ["bench", "bank"], 2),
        (2, "gato", "ˈɡa.to", "noun", ["Animal felino doméstico"], ["חתול"], ["cat"], 3),
    ], ES)


def hebrew(spark):
    return spark.createDataFrame([
        (0, "בית", "/ba.jit/", ["Casa, hogar"], ["casa"]), (1, "ספסל", "/saf.sal/", ["Asiento largo para varias personas"], ["banco"]),
        (2, "בנק", "/bank/", ["Institución que maneja dinero"], ["banco"]), (3, "חתול", "/xa.tul/", ["Mamífero carnívoro felino"], ["gato"]),
    ], HE)


def one(spark, word, he, definitions, rank=1, row_idx=0):
    return spark.createDataFrame([(row_idx, word, "", "noun", definitions, he, [], rank)], ES)
