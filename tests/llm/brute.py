"""Plain versions of the operators, for small inputs."""

import hashlib


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def repeated(rows, width):
    """rows: (doc_id, tokens).  For each row the flags of the tokens to remove."""
    first = {}
    for d, t in rows:
        if d is not None:
            for i in range(len(t) - width + 1):
                k = tuple(t[i:i + width])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        gone = [False] * len(t)
        for i in range(len(t) - width + 1):
            if d is not None and first[tuple(t[i:i + width])] < d:
                gone[i:i + width] = [True] * width
        out.append(gone)
    return out
