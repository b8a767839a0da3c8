"""Dump files that the tests write."""


def write(path, text):
    with open(path, "w", newline="") as f:
        f.write(text)
    return path
