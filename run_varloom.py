"""Start script for ``spark-submit --py-files varloom.zip run_varloom.py <command> ...``."""

from varloom.__main__ import main

if __name__ == "__main__":
    main()
