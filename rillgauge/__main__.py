from rillgauge.cli import main

main()
