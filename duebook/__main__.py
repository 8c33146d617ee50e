from duebook.cli import main

main()
