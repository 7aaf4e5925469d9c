from urbanlens.cli import main

main()
