"""spark-submit entry point: ``spark-submit --py-files logsift.zip submit.py
stream|batch ...`` (see ``logsift/streaming/main.py``)."""

from logsift.streaming.main import main

if __name__ == "__main__":
    main()
