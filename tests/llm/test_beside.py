"""Spans beside base spans."""

from ludolytics.llm import pii


def test_field_decodes_beside_base_spans():
    field = pii.train()
    for text, base, added in [
        ("call +1 (826) 555-4081 190.137.223.204 now", "190.137.223.204", "+1 (826) 555-4081"),
        ("see 192.168.0.1 555-123-4567 for it", "192.168.0.1", "555-123-4567"),
    ]:
        found = {(kind, text[a:b], own) for kind, a, b, own in pii.find(text, field)}
        assert found == {("ip", base, True), ("phone", added, False)}
        assert pii.mask_text(text, pii.find(text, field)).count("<PHONE>") == 1
