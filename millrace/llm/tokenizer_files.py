"""Where the public vocabulary files are; the folder is a parameter."""

from __future__ import annotations

import os


def path(name: str = "byte_bpe_50k.json", folder: str | None = None) -> str:
    """``name`` in ``folder``, or in the installed package of public vocabularies, or in /opt/tokenizers."""
    if folder:
        return os.path.join(folder, name)
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join("/opt/tokenizers", name)
    return public_tokenizers.path(name)
