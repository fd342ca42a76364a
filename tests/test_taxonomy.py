"""Phrases whose labels are fixed, beside the engine's own rules."""

import pytest

from casegrain.operators.taxonomy import alias_pattern, normal_phrase, taxonomy

NORMAL, DONE = "normal_or_negative_report", "postoperative_or_resolved_state"
# Phrases and their labels.
PHRASES = {
    "diagnosis": {
        "mass_or_lesion": "cancer|tumor|tumour|neoplasm|lump|mass|nodule|lesion|TUMOURS|lesions|masses|hepatocellular carcinoma|HCC|brain metastasis|brain metastases|metastatic brain tumor|meningiomas|"
        "cystic neoplasm|cystic lymphangioma|no change in tumor|treated tumor|inflammatory myofibroblastic tumor",
        "infection_or_abscess": "hepatic abscess|liver abscess|abscess lesion",
        "cystic_disorder": "cystic lesion|aneurysmal bone cyst",
        "hemorrhage_or_hematoma": "hematoma|haematoma|hematomas|no resolution of hematoma|partially resolved hematoma",
        "thrombosis_or_embolism": "thrombus|thrombosis|embolism",
        "neurologic_disorder": "PRES|posterior reversible encephalopathy syndrome",
        "hemorrhage_or_hematoma mass_or_lesion": "tumor with hemorrhage",
        NORMAL: "no tumor|no tumor or cyst|normal study|absence of mass effect",
        f"edema_or_effusion {NORMAL}": "no tumor but pleural effusion",
        f"hemorrhage_or_hematoma {NORMAL}": "hemorrhage and no tumor",
        f"mass_or_lesion {NORMAL}": "tumor without hemorrhage",
        DONE: "resolved hematoma|hematoma has resolved|resolution of hematoma|postoperative changes",
        f"mass_or_lesion {DONE}": "resolved abscess with new tumor",
        "inflammatory_or_autoimmune_disorder": "inflammatory pseudotumor",
        "eye_or_orbit_disorder": "retinal detachment lesion",
        "aneurysm_or_dissection": "hepatic artery pseudoaneurysm",
        "congenital_or_developmental_disorder": "fibrous dysplasia",
        "other": "unknown diagnosis|liver|CT|stenosis",
    },
    "modality": {
        "ct": "CT|CTA|CBCT|computed tomography|CT angiography",
        "mri": "MRI/MRA/MRCP|magnetic resonance imaging|magnetic resonance angiography",
        "radiography": "X-ray|radiograph|panoramic radiograph|mammography",
        "ultrasound": "ultrasound/sonography/echocardiography/TTE/TEE",
        "nuclear_medicine": "PET/SPECT/scintigraphy|single photon emission computed tomography",
        "ct nuclear_medicine": "PET/CT|PET–CT",
        "ct mri": "CT and MRI",
        "optical_imaging": "fluorescein angiography",
        "angiography_fluoroscopy": "angiography",
        "endoscopy": "thoracoscopy",
        "other": "unknown modality",
    },
    "anatomy": {
        "hepatobiliary_pancreatic": "liver segment VIII|hepatic lobe|biliary tract|pancreas",
        "spine_spinal_cord": "cervical spine|lumbar spine|spinal cord",
        "musculoskeletal": "femur / knee / shoulder / skeletal muscle",
        "vasculature": "hepatic artery|hepatic arterial branches|pulmonary artery",
        "hepatobiliary_pancreatic vasculature": "hepatic artery and liver",
        "heart": "left pulmonary valve|left ventricle",
        "brain_intracranial": "lateral ventricles",
        "other": "unknown anatomy",
    },
}
CASES = [(f, p, labels.split()) for f, by in PHRASES.items() for labels, ps in by.items() for p in ps.split("|")]


@pytest.mark.parametrize(("field", "phrase", "labels"), CASES)
def test_phrase(field, phrase, labels):
    assert taxonomy().labels(field, phrase) == sorted(labels)


def test_count_and_categories():
    assert len(CASES) == 96
    t = taxonomy()
    assert all(set(labels) <= set(t.categories[f]) for f, _, labels in CASES)


def test_normal_phrase():
    assert normal_phrase("  Ödème–NON_typé: 1.5 cm. ") == "odeme non type 1.5 cm"
    assert normal_phrase("") == ""


def test_alias_plurals():
    assert alias_pattern("biopsy") == "biops(?:y|ies)"
    assert alias_pattern("mass") == "mass"
    assert alias_pattern("lesion") == "lesions?"


def test_all_species_rules_over_titles_and_descriptions(spark, tmp_path):
    import re
    from collections import Counter

    from casegrain.operators import species
    from casegrain.plans.dataset_queries import q_species_all_rules

    rows = [("Impacted canine tooth", "A CAT scan was done in a dog."), ("A dog was treated", "The cat was treated by a vet."), ("a DOG was treated", None), (None, "Goat anti-mouse serum; canine-associated"), ("Plain", "Dog-ears")]
    spark.createDataFrame(rows, "title string, case_description string").write.parquet(str(tmp_path / "cases.parquet"))
    want = Counter()
    for k, field in enumerate(("title", "case_description")):
        for t in {(r[k] or "").lower() for r in rows}:
            want.update(f"{field}:species:{n}" for n, p in species.SPECIES.items() if re.search(rf"\b(?:{p})\b", t))
            want.update(f"{field}:{n}" for n, p in species.CONTEXT.items() if re.search(p, t))
            want.update(f"{field}:ambiguous:{n}" for n, p in species.AMBIGUOUS.items() if re.search(p, t))
            want.update([f"{field}:explicit_nonhuman_subject"] * (t in ("a dog was treated", "the cat was treated by a vet.", "a cat scan was done in a dog.")))
    got = {tuple(r) for r in q_species_all_rules(spark, str(tmp_path)).collect()}
    assert got == set(want.items()) and ("case_description:ambiguous:cat_scan", 1) in got
