"""Plain versions that several tests compare with."""


def one_edit_apart(a, b):
    """Do the texts differ by exactly one inserted, deleted or replaced code point?"""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]
