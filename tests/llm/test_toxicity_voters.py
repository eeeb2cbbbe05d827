from basketry.llm.toxicity_weak import pick_voters


def test_every_term_that_qualifies_votes():
    toxic = {f"=sign{k:03d}": 30 - k // 10 for k in range(150)} | {f"=common{k}": 90 for k in range(500)}
    clean = {f"=common{k}": 900 for k in range(500)}
    assert pick_voters(toxic, clean, 100, 1000) == [f"=sign{k:03d}" for k in range(150)]


def test_a_rare_term_votes_when_chance_cannot_explain_it():
    # in 8 of 5,000 toxic texts and in no clean one of 195,000: far below one in 200 toxic texts
    assert pick_voters({"=rare": 8, "=once": 1}, {"=once": 40}, 5000, 195000) == ["=rare"]
