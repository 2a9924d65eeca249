"""The schemas of the tables, S0 to S8. Every table that has an order carries `row_idx`."""

from pyspark.sql.types import StructType

#: A raw record. `sounds` is an array of maps, so that a key with a null value differs from no key.
RAW = "word string, pos string, lang_code string, sounds array<map<string,string>>, senses array<struct<glosses:array<string>>>, translations array<struct<lang_code:string,code:string,word:string>>"
ENTRIES_ES = "row_idx long, word string, pos string, ipa string, definitions array<string>, translations_en array<string>, translations_fr array<string>, translations_de array<string>, translations_he array<string>"
ENTRIES_HE = ENTRIES_ES.replace("translations_he", "translations_es")
BRIDGE = "row_idx long, source_lang string, word string, pos string, ipa string, definitions array<string>, translations_es array<string>, translations_he array<string>, bridge_source string"
SENTENCES = "id string, lang string, text string"
EXAMPLES = "row_idx long, es string, he string, es_words array<string>, he_words array<string>"
ALIGNED = "ord struct<stage:int,a:long,b:long,c:long>, es_word string, es_ipa string, es_pos string, es_definition string, he_word string, he_ipa string, he_definition string, sense_id int, match_type string, confidence double"
SENSE = "struct<sense_id:int,definition:string,ipa_hebrew:string,hebrew:string,pos:string,examples:array<struct<es:string,he:string>>>"
DICTIONARY = f"id string, entry struct<word:string,ipa:string,language:string,etymology:string,senses:array<{SENSE}>>"


def schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
