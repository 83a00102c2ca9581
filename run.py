"""Start a job: `spark-submit run.py analyses --videos … --categories …`."""

from tidemark.jobs import main

if __name__ == "__main__":
    main()
