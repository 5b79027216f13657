"""Entry point for spark-submit; see ``tarmac/__main__.py`` for the commands."""

from tarmac.__main__ import main

if __name__ == "__main__":
    main()
