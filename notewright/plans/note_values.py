"""Words of the notes that the fixture renders. They are examples, free to change; only the
diagnoses, sites, histologies, marker and drug names are those that the rules know."""

# (diagnosis, wordings, site, histology, ((biomarker, statuses), ...), medications)
CANCERS = (
    ("invasive ductal carcinoma of the breast",
     ("ductal carcinoma, right breast", "biopsy-proven IDC", "a breast primary of ductal type"),
     "breast", "invasive ductal carcinoma",
     (("ER", ("positive", "negative", "95%")), ("PR", ("negative", "positive")),
      ("HER2", ("negative", "positive", "equivocal")), ("Ki-67", ("8%", "22%", "60%"))),
     ("paclitaxel", "anastrozole", "tamoxifen", "trastuzumab", "doxorubicin")),
    ("non-small cell lung cancer, adenocarcinoma",
     ("NSCLC of the left upper lobe", "a non-small cell lung tumor", "lung adenocarcinoma"),
     "lung", "adenocarcinoma",
     (("ALK", ("negative", "rearranged")), ("EGFR", ("wild-type", "mutated")),
      ("KRAS", ("wild-type", "mutated")), ("PD-L1", ("<1%", "5%", "70%"))),
     ("carboplatin", "pemetrexed", "osimertinib", "alectinib", "pembrolizumab")),
    ("colorectal adenocarcinoma",
     ("a sigmoid colon tumor", "colorectal carcinoma", "carcinoma of the ascending colon"),
     "colon", "adenocarcinoma",
     (("MSI", ("stable", "high")), ("BRAF", ("wild-type", "V600E found")),
      ("KRAS", ("wild-type", "mutated"))),
     ("capecitabine", "FOLFOX", "irinotecan", "bevacizumab", "cetuximab")),
    ("cutaneous malignant melanoma",
     ("nodular melanoma", "melanoma of the scalp", "an ulcerated melanoma"),
     "skin", "malignant melanoma",
     (("NRAS", ("wild-type", "mutated")), ("BRAF", ("V600E found", "wild-type"))),
     ("nivolumab", "ipilimumab", "trametinib", "dabrafenib")),
    ("prostate adenocarcinoma",
     ("acinar carcinoma of the prostate", "a prostate primary"),
     "prostate", "adenocarcinoma",
     (("PSA", ("4.1 ng/mL", "11.7 ng/mL", "36.9 ng/mL")),),
     ("docetaxel", "leuprolide", "enzalutamide", "abiraterone")),
)

T_VALUES = ("T1", "T2", "T3", "T4")
N_VALUES = ("N0", "N1", "N2")
M_VALUES = ("M0", "M1")
STAGE_VALUES = ("I", "IIA", "IIB", "IIIA", "IIIB", "IV")
PROVIDERS = ("Dr. K. Lindqvist", "Dr. B. Osei", "Dr. H. Tanaka", "Dr. V. Moreau", "Dr. E. Brandt")
FIRST_NAMES = ("Ingrid", "Tomas", "Aiko", "Samuel", "Noor", "Elena", "Pavel")
LAST_NAMES = ("Hofer", "Adeyemi", "Larsen", "Kim", "Petrov", "Quist", "Moreno", "Walsh")

# what each shape leaves out of the gold labels: the third performance status, the fourth markers and drugs
NOTE_TEMPLATES = (
    ("Seen {dos} by {provider}. MRN: {mrn}\n"
     "Background - {dx} in a {sex} patient of {age}\n"
     "Extent - {tnm}\n"
     "Tumor markers - {bio}\n"
     "Function - ECOG performance status {ecog}\n"
     "Next - goes on with {meds}, scan in spring"),
    ("Patient {name} (MRN {mrn}) came on {dos}; {provider} has followed this {age} year old {sex} "
     "for {dx}. By now we call it {tnm}. The laboratory reports {bio}. "
     "On the day ECOG {ecog}, eating well. Given {meds} without trouble. To be shown to the board."),
    ("Letter of {dos}, MRN {mrn}, {provider}\n"
     "{tnm}: {dx}.\n"
     "Receptors and genes: {bio}.\n"
     "We propose {meds} and imaging after three cycles."),
    ("New referral, {sex}, {age}. {dx}, {tnm}, ECOG {ecog}. Treatment not yet chosen."),
)
NOTE_KEY_FORMAT = "NOTE-%04d"
