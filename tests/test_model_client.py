"""Requests and replies of the providers, with injected answers."""

import pytest

from biblioforge.operators.model_client import Reply, create_client

ANSWERS = {
    "claude": ({"content": [{"text": "a"}], "usage": {"input_tokens": 3, "output_tokens": 4}}, Reply("a", 3, 4)),
    "openai": ({"choices": [{"message": {"content": "b"}}], "usage": {"prompt_tokens": 5, "completion_tokens": 6}}, Reply("b", 5, 6)),
    "gemini": ({"candidates": [{"content": {"parts": [{"text": "c"}]}}]}, Reply("c", 0, 0)),
}


@pytest.mark.parametrize("provider", sorted(ANSWERS))
def test_providers(provider):
    sent = []
    answer, want = ANSWERS[provider]
    client = create_client(provider, key="secret", model="m1", post=lambda *a: sent.append(a) or answer)
    assert client.call("why?") == want
    url, headers, body = sent[0]
    assert url.startswith("https://") and any("secret" in v for v in headers.values()) and "why?" in str(body) and "m1" in url + str(body)


def test_unknown_provider():
    with pytest.raises(ValueError, match="unknown provider"):
        create_client("none")
