"""Ranks, statuses and their spellings."""

from __future__ import annotations

# The ranks in their order; comparisons of ranks use this order.
RANKS = (
    "KINGDOM", "SUBKINGDOM", "PHYLUM", "SUBPHYLUM", "CLASS", "SUBCLASS", "ORDER", "SUBORDER", "FAMILY", "SUBFAMILY",
    "TRIBE", "SUBTRIBE", "GENUS", "SUBGENUS", "SECTION", "SUBSECTION", "SERIES", "SUBSERIES", "SPECIES", "GREX",
    "SUBSPECIES", "VARIETY", "SUBVARIETY", "FORM", "SUBFORM", "LUSUS", "CULTIVAR", "COMPLEX", "UNRANKED",
)

# Spellings of each rank in source files.
RANK_SPELLINGS = {
    "kingdom": ("kingdom", "regn.", "domain"),
    "subkingdom": ("subkingdom", "subregn."),
    "phylum": ("division", "div.", "phylum", "superphylum"),
    "subphylum": ("subdivision", "subdiv.", "subdivf.", "subphylum", "cohort"),
    "order": ("order", "ordo", "superorder"),
    "suborder": ("suborder", "subordo", "infraorder", "parvorder"),
    "class": ("class", "cl.", "superclass"),
    "subclass": ("subclass", "subcl.", "infraclass"),
    "family": ("family", "fam.", "superfamily"),
    "subfamily": ("subfamily", "subfam."),
    "tribe": ("tribe", "trib.", "tr.", "supertribe", "supertrib."),
    "subtribe": ("subtribe", "subtr.", "subtrib.", "nothosubtrib.", "supersubtribe", "supersubtrib."),
    "genus": ("genus", "gen.", "genitor"),
    "subgenus": ("subgenus", "subg.", "subgen.", "nothosubgen.", "subgenitor", "microgen.", "microgène", "microgene", "genushybrid"),
    "section": ("section", "sect.", "nothosect.", "grex_sect.", "section botany", "supersection", "supersect.", "suprasect."),
    "subsection": ("subsection", "subsect.", "nothosubsect."),
    "series": ("series", "ser.", "nothoser.", "gen. ser.", "superseries", "superser."),
    "subseries": ("subseries", "subser."),
    "species": ("species", "spec.", "agamosp.", "psp.", "sp.", "nothosp.", "sp", "ichnospecies", "aff.", "cf.", "mad.", "s."),
    "grex": ("grex", "[infragen.grex]", "infragen.grex", "nothogrex"),
    "subspecies": ("subspecies", "subsp.", "subspec.", "ssp.", "nothosubsp.", "subspecioid", "subspecies (plantae)", "subsubsp."),
    "variety": ("variety", "var.", "nothovar.", "convariety", "convar.", "agamovar.", "prol.", "proles", "provar.", "[beta].", "*", "infrahybrid", "hybrid", "pseudovar.", "var", "varietas"),
    "subvariety": ("subvariety", "subvar.", "subsubvar.", "stirps", "linea", "subhybr.", "subproles", "race"),
    "form": ("form", "f.", "fo.", "f.sp.", "forma", "nothof.", "mut.", "modif.", "cycl.", "ap.", "oec.", "nm.", "monstr.", "micromorphe", "ecas.", "mod.", "forma specialis", "morph"),
    "subform": ("subform", "subf.", "subfo.", "subsubforma", "microf.", "subsubf.", "strain"),
    "lusus": ("lusus", "lus.", "sublus.", "sublusus"),
    "cultivar": ("cultivar", "cult."),
    "complex": ("complex", "gruppe", "group", "agglom.", "nid", "species group", "species subgroup", "pathogroup"),
    "unranked": ("unranked", "[unranked]", "[infragen.unranked]", "[infrasp.unranked]", "[infragen.]", "[infragen]", "[infrafam.unranked]", "positio", "-", "no rank"),
}

# Spellings of each status in source files.
STATUS_SPELLINGS = {
    "accepted": ("accepted", "provisionally accepted", "legitimate"),
    "edgecase": ("artificial hybrid", "local biotype"),
    "unplaced": ("unchecked", "unplaced", "uncertain"),
    "synonym": ("synonym", "ambiguous synonym", "heterotypic synonym", "heterotypic_synonym", "homotypic synonym", "homotypic_synonym", "proparte synonym"),
    "problematic": ("doubtful", "illegitimate", "invalid", "orthographic", "misapplied", "orthographic variant", "unavailable", "deleted"),
}

# Rank spellings that mark a hybrid beside the prefix "notho".
HYBRID_RANKS = ("genushybrid", "hybrid", "infrahybrid", "subhybr.", "grex", "[infragen.grex]", "infragen.grex", "grex_sect.")

# Rank abbreviations that may be left inside names.
NAME_RANK_TOKENS = (
    "ser", "sect", "subsect", "subgen", "sub", "bb", "ab", "mut", "var", "subvar", "convar", "race", "subsp", "subspec", "ssp", "forma", "form", "subf",
    "f", "fo", "fma", "unr", "lus", "lusus", "prol", "proles", "sp nov", "sp. nov", "f.sp.", "[unranked]",
)

# Quote characters that become an apostrophe.
QUOTES = '"ʽ‛‟′″‴’‘'

# Letters that lose their diacritics, and what they become.
DIACRITICS = "àáâãäåāăąçćčďèéêëēėęěìíîïīįıñńňòóôõöøōřśšùúûüūýÿžźż"
PLAIN = "aaaaaaaaacccdeeeeeeeeiiiiiiinnnooooooorssuuuuuyyzzz"

# Authorities whose vote on acceptance counts, by kingdom.
AUTHORITIES = {"plantae": ("wcvp", "powo", "wfo", "col", "inaturalist", "gbif"), "fungi": ("col", "inaturalist", "gbif")}
